"""Inline event tables."""

from pyspark.sql import functions as F

from footfall.schema import EVENT_SCHEMA

DAY = 1_704_067_200_000  # 2024-01-01 00:00 UTC
HOUR = 3_600_000


def events(spark, *rows, **defaults):
    """Events of one device from (eventTime, eventName, {more}) or dicts."""
    base = {"projectId": "p1", "siteId": "s1", "deviceId": "d1", "eventBody": "{}", **defaults}
    full = []
    for i, row in enumerate(rows):
        if isinstance(row, tuple):
            more = row[2] if len(row) > 2 else {}
            row = {"eventTime": row[0], "eventName": row[1], **more}
        full.append({**base, "sn": i + 1, **row})
    schema = [f for f in EVENT_SCHEMA if f.name != "extra"]
    data = [tuple(None if r.get(f.name) is None else (str(r[f.name])) for f in schema) for r in full]
    df = spark.createDataFrame(data, ", ".join(f"{f.name} STRING" for f in schema))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def column(df, name, order="sn"):
    return [r[0] for r in df.orderBy(order).select(name).collect()]
