"""T1 query: events delivered as daily files, several days re-delivered."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import snapshots
from ..session import staging_path
from ..streaming.arrival import arrival_merge
from .registry import query

REDELIVERED_DAY = "2024-01-05"  # twice in the second pass; the last one counts
EMPTIED_DAY = "2024-01-07"  # re-delivered with rows that are all filtered out
REPLACED_DAY = "2024-01-09"  # its file is replaced in place
REPEATED_DAY = "2024-01-11"  # delivered again in the same folder under another name
BROKEN_DAY = "2024-01-13"  # its file is replaced by one that can't be read

_DAYS = (REDELIVERED_DAY, EMPTIED_DAY, REPLACED_DAY, REPEATED_DAY)


def _events(t):
    return t("events").select("event_id", "user_id", "event_type", "value",
                              F.concat(F.lit("events_"), F.date_format("ts", "yyyy-MM-dd")).alias("ARQUIVO_ORIGEM"))


def _day(e, day):
    return e.filter(F.col("ARQUIVO_ORIGEM") == f"events_{day}")


def _put(df, folder, name, form="parquet"):
    """``df`` as one file of that name, over what is there."""
    from ..operators.snapshots import _path
    from ..session import remove_path

    spark, work = df.sparkSession, staging_path(df.sparkSession, "put")
    df.coalesce(1).write.format(form).save(work)
    fs, p = _path(spark, work)
    part = next(s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-"))
    remove_path(spark, f"{folder}/{name}")
    fs.mkdirs(_path(spark, folder)[1])
    fs.rename(part, _path(spark, f"{folder}/{name}")[1])
    remove_path(spark, work)


@query("stream_arrival_merge", f"""select event_id, user_id, event_type,
  case strftime(ts, '%Y-%m-%d') when '{REDELIVERED_DAY}' then value * 2 when '{REPLACED_DAY}' then value * 5
    when '{REPEATED_DAY}' then value * 7 else value end as value,
  'events_' || strftime(ts, '%Y-%m-%d') as ARQUIVO_ORIGEM from events
where event_type <> 'noise' and strftime(ts, '%Y-%m-%d') <> '{EMPTIED_DAY}'
  and (strftime(ts, '%Y-%m-%d') not in ('{REDELIVERED_DAY}', '{REPLACED_DAY}') or event_id % 2 = 0)""")
def stream_arrival_merge(t):
    """Daily deliveries land in parts that hold pieces of every day, and are
    taken two files at a time; three days have files of their own.  In the
    second pass one day is re-delivered twice, another with nothing to keep,
    one file is replaced in place, one day comes again in its folder under
    another name, and one file is replaced by one that can't be read: its day
    stays as it is.  The published table is read back."""
    spark = t.spark
    e = _events(t)
    landing, table = staging_path(spark, "landing"), staging_path(spark, "published")
    own = [f"events_{d}" for d in (REPLACED_DAY, REPEATED_DAY, BROKEN_DAY)]
    e.filter(~F.col("ARQUIVO_ORIGEM").isin(own)).repartition(4).write.parquet(f"{landing}/entrega=1")
    for day in (REPLACED_DAY, REPEATED_DAY, BROKEN_DAY):
        _put(_day(e, day), f"{landing}/dias", f"{day}.parquet")

    def transform(df):
        return df.filter(F.col("event_type") != "noise")

    ckpt = arrival_merge(spark, landing, e.schema, table, "ARQUIVO_ORIGEM", transform, files_per_trigger=2)
    again = _day(e, REDELIVERED_DAY)
    again.withColumn("value", F.col("value") * 3).unionByName(
        _day(e, EMPTIED_DAY).withColumn("event_type", F.lit("noise"))).write.parquet(f"{landing}/entrega=2")
    again.filter(F.col("event_id") % 2 == 0).withColumn("value", F.col("value") * 2).write.parquet(f"{landing}/entrega=3")
    _put(_day(e, REPLACED_DAY).filter("event_id % 2 = 0").withColumn("value", F.col("value") * 5), f"{landing}/dias", f"{REPLACED_DAY}.parquet")
    _put(_day(e, REPEATED_DAY).withColumn("value", F.col("value") * 7), f"{landing}/dias", "again.parquet")
    _put(_day(e, BROKEN_DAY).select("event_type"), f"{landing}/dias", f"{BROKEN_DAY}.parquet", "text")  # no parquet inside
    arrival_merge(spark, landing, e.schema, table, "ARQUIVO_ORIGEM", transform, checkpoint=ckpt)
    return snapshots.read(spark, table)
