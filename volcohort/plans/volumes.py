"""More of the catalogue: volumes as files."""

from __future__ import annotations

from pyspark.sql import functions as F

from volcohort.operators import voxel
from volcohort.operators.storage import shared_dir, staged
from volcohort.plans.catalogue import VOXEL_SQL, _voxels, query, table
from volcohort.plans.refine import ORACLES, QUERIES
from volcohort.sources import volumes

__all__ = ["ORACLES", "QUERIES"]


def _written(spark, sf_dir):
    """The folder of a volume for each supplier, new for each call."""
    grids = table(spark, sf_dir, "supplier").selectExpr("s_suppkey case_id", "16 ni", "16 nj", "8 nk", "1.0D + s_nationkey % 3 si", "1.5D sj", "2.0D sk")
    path = f"{shared_dir(spark)}/volumes-{spark.range(1).select(F.uuid()).first()[0]}"
    staged(volumes.write_volumes(voxel.runs(_voxels(spark, sf_dir, 3, 8)), grids, path), "volumes-written")
    return path


@query(f"""with {VOXEL_SQL}, g as (select *, i - row_number() over (partition by c, k, j, l order by i) g from A where l <> 0)
  select cast(c as varchar) case_id, cast(k as int) k, cast(j as int) j, l as "label", cast(min(i) as int) i0, cast(max(i) as int) i1 from g group by c, k, j, l, g""")
def volume_files(spark, sf_dir):
    return volumes.volumes(spark, _written(spark, sf_dir), slab=4)


@query(f"""with {VOXEL_SQL} select cast(c as varchar) case_id, l as "label", count(*) voxels from A where l <> 0 and c % 3 = 1 and c < 200 group by c, l""")
def volumes_of_cases(spark, sf_dir):
    """Some cases of a folder: the files of the others aren't opened."""
    r = volumes.volumes(spark, _written(spark, sf_dir), [str(c) for c in range(1, 200, 3)])
    return voxel.volumes(r)


@query("select cast(s_suppkey as varchar) case_id, '16,16,8' shape, 1.0::double + s_nationkey % 3 si, cast(352 + 4096 as bigint) bytes from supplier")
def volume_headers(spark, sf_dir):
    """Read twice: the second time from the table of headers."""
    path = _written(spark, sf_dir)
    cache = path.replace("/volumes-", "/headers-")
    volumes.cached_headers(spark, path, cache)
    h = volumes.cached_headers(spark, path, cache)
    name = F.regexp_extract("file", r"([^/]+)\.nii$", 1)
    return h.select(name.alias("case_id"), F.array_join(F.transform("shape", lambda x: x.cast("string")), ",").alias("shape"), F.get("spacing", F.lit(0)).alias("si"), "bytes")
