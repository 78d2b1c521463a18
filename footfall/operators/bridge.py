"""Events of web pages embedded in an app, and both protocols side by side."""

from pyspark.sql import DataFrame, Window as W, functions as F


def _bridge_json(source_project, host_project, source_site, host_site, flag):
    return F.to_json(
        F.struct(
            source_project.alias("sourceProjectId"),
            F.lit(host_project).alias("destProjectId"),
            source_site.alias("sourceSiteId"),
            F.lit(host_site).alias("destSiteId"),
            flag.cast("int").alias("dupFlag"),
        )
    )


def bridge_fan_out(h5: DataFrame, project: str, site: str, forward: bool = True) -> DataFrame:
    """Rows of embedded pages for the host project, and, when `forward`, a second
    row for the page's own project if that is another one. The host's copy of
    such an event has dupFlag 1, the other 0. One scan, no shuffle."""
    other = F.coalesce(F.col("projectId") != project, F.lit(False))
    source = F.when(other, F.col("projectId")).otherwise(F.lit(project))
    host = F.struct(
        F.lit(project).alias("projectId"),
        F.lit(site).alias("siteId"),
        _bridge_json(source, project, F.col("siteId"), site, F.when(other, 1)).alias("bridgeInfo"),
    )
    own = F.struct(
        F.col("projectId"),
        F.coalesce("siteId", F.lit(site)).alias("siteId"),
        _bridge_json(source, project, F.col("siteId"), site, F.lit(0)).alias("bridgeInfo"),
    )
    copies = F.when(other, F.array(host, own)).otherwise(F.array(host)) if forward else F.array(host)
    rows = h5.withColumn("__copy", F.explode(copies)).drop("projectId", "siteId", "bridgeInfo")
    return rows.select(*rows.drop("__copy").columns, "__copy.*")


def bridge_info(events: DataFrame) -> DataFrame:
    """Columns out of `bridgeInfo`; `dupFlag` is absent within one project."""
    fields = (
        "sourceProjectId STRING, destProjectId STRING, sourceSiteId STRING, destSiteId STRING, "
        "dupFlag INT"
    )
    return events.withColumn("__b", F.from_json("bridgeInfo", fields)).select(
        *events.columns, "__b.*"
    )


def drop_bridge_duplicates(events: DataFrame) -> DataFrame:
    """Leave out copies that another project also counts; for totals over all
    projects."""
    flag = F.from_json("bridgeInfo", "dupFlag INT")["dupFlag"]
    return events.where(F.coalesce(flag, F.lit(0)) == 0)


def unify_protocols(legacy: DataFrame, events: DataFrame) -> DataFrame:
    """Both protocols in one table, told apart by `protocol`. They hold the same
    actions, so never add them up."""
    return legacy.withColumn("protocol", F.lit("v1")).unionByName(
        events.withColumn("protocol", F.lit("v2")), allowMissingColumns=True
    )


def unpaired(legacy: DataFrame, events: DataFrame, keys, order=()) -> DataFrame:
    """Rows of either protocol that the other has no partner for, told apart by `protocol`.

    Rows are paired by `keys` (such as device, second and name), equal ones one to one: of m and
    n rows with the same keys, m - n of the larger side are left, the last ones by `order`. Keys
    are counted first, combined in the map tasks, so only rows of keys with unequal counts are
    shuffled. Null keys pair with null keys."""
    keys, order = list(keys), list(order) or list(keys)
    sides = {"v1": legacy, "v2": events}
    counts = None
    for name, rows in sides.items():
        some = rows.select(*keys, *[F.lit(int(name == other)).alias(other) for other in sides])
        counts = some if counts is None else counts.unionByName(some)
    counts = counts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sides]).where("v1 <> v2").alias("c")
    out = None
    for name, rows in sides.items():
        other = next(c for c in sides if c != name)
        same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
        more = rows.alias("r").join(counts.where(F.col(name) > F.col(other)), same).select("r.*", F.col(f"c.{other}").alias("__pairs"))
        rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
        left = more.withColumn("__rank", rank).where("__rank > __pairs").drop("__rank", "__pairs")
        left = left.withColumn("protocol", F.lit(name))
        out = left if out is None else out.unionByName(left, allowMissingColumns=True)
    return out
