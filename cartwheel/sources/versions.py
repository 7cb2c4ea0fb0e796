"""Tables refreshed as a whole: one ``version=`` folder per refresh, and a log of changes written with each.

``root/version=<number>[.<writer>]`` holds a whole table and counts once it has ``_SUCCESS``. ``root.changes/version=<number>``
holds what that refresh changed: distinct rows with the number of copies that came (positive) or went (negative). A feed over
a range of versions adds up these numbers and never opens the tables, so its cost follows the changes, and old versions can
be removed while their changes stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import changes


def version_number(path: str) -> int:
    return int(path.rsplit("/version=", 1)[1].split(".", 1)[0])


def versions(spark: SparkSession, root: str) -> list[str]:
    """Committed ``version=`` folders under ``root``, by number. Lists one directory."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = [st.getPath() for st in fs.listStatus(path)]
    return sorted((p.toString() for p in found if p.getName().startswith("version=")
                   and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))), key=version_number)


def latest_version(spark: SparkSession, root: str) -> str | None:
    """The newest committed version folder."""
    return max(versions(spark, root), default=None, key=version_number)


def _log_root(root: str) -> str:
    return f"{root.rstrip('/')}.changes"


def write_changes(spark: SparkSession, root: str) -> list[int]:
    """Write the change log of every version that has none yet: the newest as a rule, or more after a crash between a
    table and its log. Returns their numbers. The first version has no log, as nothing came before it."""
    tables = versions(spark, root)
    logged = {version_number(p) for p in versions(spark, _log_root(root))}
    done = []
    for before, after in zip(tables, tables[1:]):
        number = version_number(after)
        if number not in logged:
            net = changes.net_rows(spark.read.parquet(before), spark.read.parquet(after))
            net.write.mode("overwrite").parquet(f"{_log_root(root)}/version={number:012d}")
            done.append(number)
    return done


def _rename(spark: SparkSession, old: str, new: str) -> None:
    jvm = spark.sparkContext._jvm
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (old, new))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target) or not fs.rename(source, target):
        raise RuntimeError(f"{new} is there already")


def write_refresh(df: DataFrame, root: str, number: int | None = None, primary_key: list[str] | None = None) -> int:
    """Store ``df`` as the next version (or the given number) together with its change log.

    ``primary_key``: the rows are staged first and published by a rename only if no key repeats or holds a null; else
    :class:`changes.ConstraintViolation`, and the newest version stays what it was. Staged rows are sorted by the key within
    each file, so a (key, time) lookup reads few row groups.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    newest = latest_version(spark, root)
    if number is None:
        number = version_number(newest) + 1 if newest else 0
    target = f"{root}/version={number:012d}"
    if primary_key is None:
        df.write.mode("overwrite").parquet(target)
    else:
        staged = f"{root}.staged/version={number:012d}"
        df.repartition(*primary_key[:1]).sortWithinPartitions(*primary_key).write.mode("overwrite").parquet(staged)
        changes.require_primary_key(spark.read.schema(df.schema).parquet(staged), primary_key)
        _rename(spark, staged, target)
    write_changes(spark, root)
    return number


def append_new_rows(spark: SparkSession, root: str, out: str) -> list[int]:
    """Turn a table that is rewritten by every refresh into one that only grows: for each version not taken over yet, the
    rows that it added (a row that came twice comes twice) go to a folder ``version=`` of ``out``, which a stream can read.

    A version is taken over once: its folder counts when it is whole, and a crash before that writes it again. A snapshot
    that is delivered again adds nothing. Returns the versions taken over.
    """
    done = {version_number(p) for p in versions(spark, out)}
    logs = {version_number(p): p for p in versions(spark, _log_root(root))}
    taken = []
    for path in versions(spark, root):
        number = version_number(path)
        if number in done:
            continue
        if number in logs:
            net = spark.read.parquet(logs[number])
            rows = changes.expanded(net.filter(f"{changes.COPIES} > 0"))
        elif number == version_number(versions(spark, root)[0]) and not done:
            rows = spark.read.parquet(path)
        else:
            raise ValueError(f"version {number} of {root} has no change log; write_changes() writes it")
        rows.write.mode("overwrite").parquet(f"{out.rstrip('/')}/version={number:012d}")
        taken.append(number)
    return taken


def change_feed_range(spark: SparkSession, root: str, keys: list[str], first: int, last: int) -> DataFrame:
    """The net change feed from version ``first`` to version ``last``, from the logs in between. A row that came and went
    within the range is in neither image; an update that happened in several steps is one update."""
    logs = {version_number(p): p for p in versions(spark, _log_root(root))}
    known = {version_number(p) for p in versions(spark, root)} | set(logs)
    if not first <= last or last not in known or (first not in known and first != min(logs, default=None)):
        raise ValueError(f"no versions {first} to {last} of {root}; there are {sorted(known)}")
    missing = {n for n in known if first < n <= last} - set(logs)
    if missing:
        raise ValueError(f"versions {sorted(missing)} of {root} have no change log; write_changes() writes it")
    wanted = [p for n, p in logs.items() if first < n <= last]
    if not wanted:
        return changes.feed_of(changes.no_net_rows(spark.read.parquet(latest_version(spark, root))), keys)
    return changes.feed_of(changes.compacted(spark.read.parquet(*wanted)), keys)
