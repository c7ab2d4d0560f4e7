"""Incremental state and history (L-family).

Two layers:

* frame operators - pure DataFrame -> DataFrame functions (keyed upsert,
  delete+insert, append-new, SCD2 snapshot, keep-latest dedup, point-in-time
  view). Catalyst plans them as anti/outer joins + unions; nothing is
  collected.
* ``VersionedTable`` - a Parquet table as data folders plus numbered
  manifests. A commit writes a folder of its own (a normal Spark job, so lost
  executors are simply retried) and then publishes a manifest that lists the
  folders of the new version: an append adds one folder, a keyed merge rewrites
  only the key buckets it touches. The manifest of the version after the one
  that was read is put in place whole and only if nobody else has put one
  there, so of two writers one has to read again, and readers always see a
  complete version. A failed commit leaves nothing behind but an unlisted
  folder. The difference of two manifests is a change set.

All folders live on the shared filesystem the caller names (on a cluster:
the same store as ``spark.checkpoint.dir``), never on a machine-local path.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions import core as fn
from ..session import freed_shuffles

c = F.col
_BUCKET = "_key_bucket"


# ---------------------------------------------------------------------------
# Frame operators
# ---------------------------------------------------------------------------
def keep_latest(df: DataFrame, key: list[str], order_by: list[str]) -> DataFrame:      # L08
    """One row per key: the latest by ``order_by`` (descending, last column
    as tie-break). ``row_number() = 1`` is planned with a per-partition group
    limit before the shuffle, so a hot key is reduced map-side."""
    w = Window.partitionBy(*key).orderBy(*[c(x).desc_nulls_last() for x in order_by])
    return df.withColumn("_rn", F.row_number().over(w)).filter(c("_rn") == 1).drop("_rn")


def upsert(target: DataFrame, source: DataFrame, key: list[str], order_by: list[str] | None = None) -> DataFrame:  # L02
    """MERGE: per key the newest row by ``order_by`` of source and target (the
    source's on a tie); unmatched rows are inserted. Without ``order_by`` the
    source must be unique by ``key`` (see ``require_unique``)."""
    src = (keep_latest(source, key, order_by) if order_by else source).select(*target.columns)
    if order_by:
        # a late, older row must not replace a newer one
        t = target.select(*key, F.struct(*order_by).alias("_t_order"))
        newer = (src.select(*key, F.struct(*order_by).alias("_s_order")).join(t, key)
                 .filter(c("_t_order") > c("_s_order")).select(*key).distinct())
        src = src.join(newer, key, "left_anti")
    return target.join(src.select(*key), key, "left_anti").unionByName(src)


def matched_keys(target: DataFrame, source: DataFrame, key: list[str], order_by: list[str] | None = None) -> DataFrame:
    """The keys that both have, once each, with ``_newer`` where a target row
    is newer than the source's. Only keys and order columns are read."""
    order = [F.struct(*order_by).alias("_order")] if order_by else []
    t = target.select(*key, *[x.alias("_t_order") for x in order])
    s = source.select(*key, *[x.alias("_s_order") for x in order])
    newer = F.coalesce(F.max(c("_t_order") > c("_s_order")), F.lit(False)) if order_by else F.lit(False)
    return s.join(t, key).groupBy(*key).agg(newer.alias("_newer"))


def require_unique(source: DataFrame, key: list[str]) -> None:
    """Refuse a merge source in which a key occurs twice and nothing says
    which row is newer (as MERGE does)."""
    twice = source.groupBy(*key).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"merge source has several rows for {[twice[0][k] for k in key]} and no order column")


def upsert_counts(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """inserted = staged keys not in target, updated = staged keys already there (one aggregation)."""
    t = target.select(*key).distinct().withColumn("_in_target", F.lit(True))
    s = source.select(*key).distinct().join(t, key, "left")
    return s.agg(F.count(F.when(c("_in_target").isNull(), 1)).alias("rows_inserted"),
                 F.count(F.when(c("_in_target"), 1)).alias("rows_updated"))


def delete_insert(target: DataFrame, source: DataFrame, key: list[str], watermark: str,
                  target_watermark=None) -> DataFrame:                                      # L01
    """Rows of ``source`` loaded after the target's high-water mark replace
    target rows with the same key. The mark is a literal of the caller's, or a
    scalar subquery of the plan (an empty target has none and takes all)."""
    if target_watermark is None:
        mark = target.agg(F.max(watermark)).scalar()
        new = source.filter(mark.isNull() | (c(watermark) > mark))
    else:
        new = source.filter(c(watermark) > F.lit(target_watermark))
    new = new.select(*target.columns)
    return target.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def append_new(target: DataFrame | None, source: DataFrame, ts: str, initial_since=None) -> DataFrame:  # L03
    """Rows newer than the target's max ``ts``; on the first load only rows
    since ``initial_since``. Returns the rows to append."""
    if target is None:
        return source if initial_since is None else source.filter(c(ts) >= initial_since)
    mark = target.agg(F.max(ts)).first()[0]
    return source if mark is None else source.filter(c(ts) > F.lit(mark))


SCD_COLS = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def scd2_snapshot(history: DataFrame | None, incoming: DataFrame, key: str, snapshot_ts: str,
                  check_cols: list[str] | None = None, updated_at: str | None = None,
                  invalidate_hard_deletes: bool = True) -> DataFrame:                       # L04 / L05
    """Type-2 history after one snapshot run.

    check strategy: a new version when any ``check_cols`` value changes
    (null-safe); timestamp strategy: when ``updated_at`` advances. A key
    missing from ``incoming`` has its open version closed (hard delete); a
    key that comes back gets a new version. Implemented as one full outer
    join of the open versions with the incoming rows."""
    ts = F.lit(snapshot_ts).cast("timestamp_ntz")
    data_cols = [x for x in incoming.columns]
    if updated_at:
        stamp = c(f"n.{updated_at}").cast("timestamp_ntz")
    else:
        stamp = ts

    def new_version(frame):
        vf = c(updated_at).cast("timestamp_ntz") if updated_at else ts
        return frame.select(
            *data_cols, fn.surrogate_key(key, vf).alias("dbt_scd_id"), vf.alias("dbt_updated_at"),
            vf.alias("dbt_valid_from"), F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"))

    if history is None:
        return new_version(incoming)
    closed = history.filter(c("dbt_valid_to").isNotNull())
    open_ = history.filter(c("dbt_valid_to").isNull())
    o, n = open_.alias("o"), incoming.alias("n")
    j = o.join(n, c(f"o.{key}") == c(f"n.{key}"), "full")
    if check_cols:
        changed = reduce(lambda a, b: a | b, [~c(f"o.{x}").eqNullSafe(c(f"n.{x}")) for x in check_cols])
    else:
        changed = c(f"n.{updated_at}") > c(f"o.{updated_at}")
    has_o, has_n = c(f"o.{key}").isNotNull(), c(f"n.{key}").isNotNull()
    j = j.withColumn("_action", F.when(has_o & has_n & changed, "change").when(has_o & has_n, "keep")
                     .when(has_o, "deleted").otherwise("new"))
    hist_cols = data_cols + SCD_COLS
    # open versions: closed when changed or (optionally) hard-deleted
    close_at = F.when(c("_action") == "change", stamp).when(
        (c("_action") == "deleted") & F.lit(invalidate_hard_deletes), ts)
    kept_open = j.filter(c("_action").isin("keep", "change", "deleted")).select(
        *[c(f"o.{x}").alias(x) for x in hist_cols if x != "dbt_valid_to"],
        F.coalesce(close_at, c("o.dbt_valid_to")).alias("dbt_valid_to"))
    fresh = new_version(j.filter(c("_action").isin("change", "new")).select(*[c(f"n.{x}").alias(x) for x in data_cols]))
    return closed.select(*hist_cols).unionByName(kept_open.select(*hist_cols)).unionByName(fresh.select(*hist_cols))


def current_rows(history: DataFrame) -> DataFrame:                                         # L06
    return history.filter(c("dbt_valid_to").isNull())


def as_of_rows(history: DataFrame, at: str) -> DataFrame:
    t = F.lit(at).cast("timestamp_ntz")
    return history.filter((c("dbt_valid_from") <= t) & (c("dbt_valid_to").isNull() | (t < c("dbt_valid_to"))))


def insert_missing(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:    # L07
    """MERGE ... WHEN NOT MATCHED THEN INSERT: the source rows to add."""
    return source.select(*target.columns).join(target.select(*key), key, "left_anti")


def remove_tenant(df: DataFrame, tenant: str, tenant_column: str = "hospital_id") -> DataFrame:  # L09
    return df.filter(~F.coalesce(c(tenant_column) == tenant, F.lit(False)))


def affected_keys(batch: DataFrame, key: list[str]) -> DataFrame:                          # L10
    return batch.select(*key).distinct()


def recompute_for(full_source: DataFrame, changed: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``full_source`` belonging to changed keys (semi join) - feed
    for recomputing per-key windows (e.g. readmission) after late data."""
    return full_source.join(changed, key, "left_semi")


def replace_keys(target: DataFrame, recomputed: DataFrame, key: list[str]) -> DataFrame:
    return target.join(recomputed.select(*key).distinct(), key, "left_anti").unionByName(recomputed.select(*target.columns))


# ---------------------------------------------------------------------------
# Versioned Parquet tables
# ---------------------------------------------------------------------------
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``path`` in one step with its whole content; False if it exists.

    The text goes to a file of its own first. On local disks that file gets a
    second name by a hard link, elsewhere it is renamed without overwriting;
    both fail when the name is taken, so of two writers one wins."""
    fs, final = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            files = jvm.java.nio.file.Files
            files.createLink(jvm.java.io.File(final.toUri().getPath()).toPath(), jvm.java.io.File(tmp.toUri().getPath()).toPath())
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
            none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            context.rename(tmp, final, none)
        return True
    except Exception as e:  # noqa: BLE001 - told apart by the Java class
        if "AlreadyExists" in str(e):
            return False
        raise
    finally:
        fs.delete(tmp, False)


def _comparable(col, kind):
    """A column as numbers or texts that JSON keeps and that order alike."""
    if kind.typeName() in ("byte", "short", "integer", "long", "float", "double"):
        return col
    if kind.typeName() not in ("string", "date", "timestamp", "timestamp_ntz"):
        raise ValueError(f"no file bounds for {kind.simpleString()}")
    return col.cast("string")


class CommitConflict(RuntimeError):
    """Another writer published a version since this commit's was read."""


_COMMIT = "_commit"     # folder level above partitions, so that all folders read as one relation
RETRIES = 20
PART_BYTES = 64 << 20   # of Parquet that one step of a large change shuffles; its shuffle files go before the next
MAX_PARTS = 64          # steps of a change at most, as each scans the rows that it is made from
CODEC = "zstd"          # of data files: about a quarter smaller than Spark's default


@dataclass
class VersionedTable:
    """A Parquet table as data folders and numbered manifests.

    ``key`` and ``buckets`` > 0: rows carry a hidden bucket of the key, and
    ``merge`` rewrites only the buckets its source touches. ``partition_by``:
    a folder for each value; ``drop_partition`` unlists such folders.
    ``stats``: columns of which each file's least and greatest value are kept,
    so ``read(where=...)`` leaves files out. ``feed``: merges keep their source
    rows too, for ``changes``."""

    spark: SparkSession
    base: str
    partition_by: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    buckets: int = 0
    stats: tuple[str, ...] = ()
    feed: bool = False

    # ---- manifests: <base>/_manifests/<version>
    def _folder(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def _manifests(self) -> list[int]:
        fs, p = _fs(self.spark, self._folder("_manifests"))
        if not fs.exists(p):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return sorted(int(n) for n in names if n.isdigit())

    def _manifest(self, version: int) -> dict | None:
        """A manifest, None for one that is not there or is not whole."""
        fs, p = _fs(self.spark, self._folder(f"_manifests/{version:09d}"))
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return json.loads(text) if text.endswith("\n") else None

    def _load(self, version: int) -> list[dict] | None:
        found = self._manifest(version)
        return None if found is None else found["entries"]

    def _publish(self, entries: list[dict], after: int, op: str = "replace", changes: list[str] | None = None,
                 tags: dict | None = None, schema: str | None = None) -> int:
        """Publish the version that follows ``after``, and no other: the number
        is taken only if nobody has it. A number whose manifest is not whole
        belongs to a writer that died, since manifests appear whole; it is
        passed over. ``CommitConflict`` if another writer was first."""
        old = self._manifest(after) or {}
        text = json.dumps({"entries": entries, "op": op, "changes": changes, "tags": {**old.get("tags", {}), **(tags or {})},
                           "schema": schema or old.get("schema"), "after": after}) + "\n"
        version, taken = after + 1, set(self._manifests())
        while version in taken and self._manifest(version) is None:
            version += 1
        if version in taken or any(v > version and self._manifest(v) is not None for v in taken) \
                or not _put_if_absent(self.spark, self._folder(f"_manifests/{version:09d}"), text):
            raise CommitConflict(f"{self.base}: version {after} is no longer the latest")
        return version

    def current_version(self) -> int:
        for v in reversed(self._manifests()):
            if self._manifest(v) is not None:
                return v
        return 0

    def exists(self) -> bool:
        return self.current_version() > 0

    def tag(self, name: str):
        """A value that a commit left with the table (None: never)."""
        return ((self._manifest(self.current_version()) or {}).get("tags") or {}).get(name)

    # ---- reading
    def _leaves(self, e: dict) -> list[str]:
        if e["buckets"] is None:
            return [f"{e['path']}/{x}" if x else e["path"] for x in e["leaves"]]
        live = {f"{_BUCKET}={b}" for b in e["buckets"]}
        return [f"{e['path']}/{x}" for x in e["leaves"] if x.split("/")[0] in live]

    def _files(self, e: dict, where: dict) -> list[str]:
        """The files of an entry that may hold rows within ``where``: column ->
        (least, greatest), None for no bound."""
        out = []
        for leaf in self._leaves(e):
            for f in e["files"].get(leaf[len(e["path"]):].lstrip("/"), []):
                if all(k not in f["stats"] or ((lo is None or f["stats"][k][1] is None or f["stats"][k][1] >= lo)
                                               and (hi is None or f["stats"][k][0] is None or f["stats"][k][0] <= hi))
                       for k, (lo, hi) in where.items()):
                    out.append(f"{leaf}/{f['name']}")
        return out

    def _relation(self, paths: list[str], schema: str) -> DataFrame:
        st = StructType.fromJson(json.loads(schema))
        if not paths:
            return self.spark.createDataFrame([], st)
        whole = StructType([*st.fields, StructField(_COMMIT, StringType())])
        if self.buckets:
            whole = whole.add(_BUCKET, IntegerType())
        df = self.spark.read.schema(whole).option("basePath", self._folder("data")).parquet(*[self._folder(x) for x in paths])
        return df.select(*st.fieldNames())

    def read(self, version: int | None = None, where: dict | None = None) -> DataFrame | None:
        """All rows of a version (the latest) as one relation. With ``where``
        (column -> (least, greatest)) files that hold no such row are not
        listed; the rows are filtered too."""
        v = self.current_version() if version is None else version
        m = self._manifest(v) if v else None
        if m is None or not m["schema"]:
            return None
        if not where:
            return self._relation([x for e in m["entries"] for x in self._leaves(e)], m["schema"])
        known = {k: self._bounds(m["schema"], k, b) for k, b in where.items() if k in self.stats}
        rows = self._relation([x for e in m["entries"] for x in (self._files(e, known) if known else self._leaves(e))], m["schema"])
        for k, (lo, hi) in where.items():
            kind = rows.schema[k].dataType
            if lo is not None:
                rows = rows.filter(c(k) >= F.lit(lo).cast(kind))
            if hi is not None:
                rows = rows.filter(c(k) <= F.lit(hi).cast(kind))
        return rows

    def _bounds(self, schema: str, column: str, bounds: tuple) -> list:
        """``bounds`` as they stand in a manifest."""
        kind = StructType.fromJson(json.loads(schema))[column].dataType
        return list(self.spark.range(1).select(*[_comparable(F.lit(b).cast(kind), kind) for b in bounds]).first())

    def changes(self, since: int, until: int | None = None) -> DataFrame | None:
        """Rows that versions after ``since`` added or gave a new content, read
        from the folders that these versions added; nothing else is read. None
        where they cannot be told: a replaced table, a dropped partition, a
        merge without ``feed``, folders no longer kept."""
        until = self.current_version() if until is None else until
        paths, schema = [], None
        for v in self._manifests():
            m = self._manifest(v) if since < v <= until else None
            if m is None:
                continue
            if m["op"] not in ("append", "merge", "compact") or m["changes"] is None:
                return None
            paths += m["changes"]
            schema = m["schema"]
        for x in paths:
            fs, p = _fs(self.spark, self._folder(x))
            if not fs.exists(p):
                return None
        if schema is None:
            now = self.read(until)
            return None if now is None else now.limit(0)
        return self._relation(paths, schema)

    # ---- writing
    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")) if self.buckets else df

    def _write(self, df: DataFrame) -> str:
        name = f"data/{_COMMIT}={uuid.uuid4().hex}"
        parts = [*([_BUCKET] if self.buckets else []), *self.partition_by]
        df = self._bucketed(df)
        if parts:
            # rows of a partition meet before the write, a large one in several
            # files; REBALANCE lets adaptive execution split hot partitions
            df = df.hint("rebalance", *parts)
        w = df.write.partitionBy(*parts) if parts else df.write
        with freed_shuffles(self.spark):
            w.option("compression", CODEC).parquet(self._folder(name))
        return name

    def _bytes(self, paths: list[str]) -> int:
        out = 0
        for x in paths:
            fs, p = _fs(self.spark, self._folder(x))
            out += fs.getContentSummary(p).getLength()
        return out

    def size(self, version: int, since: int = 0) -> int:
        """Bytes of a version's files; with ``since`` of the rows that ``changes`` reads."""
        if since:
            return self._bytes([x for v in self._manifests() if since < v <= version
                                for x in (self._manifest(v) or {}).get("changes") or []])
        return self._bytes([x for e in self._load(version) or [] for x in self._leaves(e)])

    def _listing(self, path: str) -> list[str]:
        """Folders with data files under ``path``, relative to it."""
        fs, top = _fs(self.spark, self._folder(path))
        depth, found = len(self.partition_by) + bool(self.buckets), [("", top)]
        for _ in range(depth):
            found = [(f"{name}/{f.getPath().getName()}".lstrip("/"), f.getPath()) for name, p in found for f in fs.listStatus(p)
                     if f.isDirectory()]
        return [name for name, _ in found]

    def _entry(self, path: str, schema: StructType, buckets: list[int] | None = None) -> dict:
        out = {"path": path, "buckets": sorted(buckets) if buckets is not None else
               (list(range(self.buckets)) if self.buckets else None), "leaves": self._listing(path), "files": {}}
        if self.stats:
            whole = StructType([*schema.fields, StructField(_COMMIT, StringType())])
            rows = self.spark.read.schema(whole).option("basePath", self._folder("data")).parquet(self._folder(path))
            bounds = [f(_comparable(c(k), rows.schema[k].dataType)).alias(f"{n}_{k}")
                      for k in self.stats for n, f in (("lo", F.min), ("hi", F.max))]
            # one row for each file that this commit wrote
            for r in rows.groupBy(c("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *bounds).collect():
                inside = r["file"].split(path.split("/", 1)[1] + "/", 1)[1]
                leaf, _, name = inside.rpartition("/")
                out["files"].setdefault(leaf, []).append(
                    {"name": name, "rows": r["rows"], "stats": {k: [r[f"lo_{k}"], r[f"hi_{k}"]] for k in self.stats}})
        return out

    def _fitted(self, df: DataFrame, schema: str | None) -> DataFrame:
        """``df`` in the table's columns and types."""
        if schema is None:
            return df
        st = StructType.fromJson(json.loads(schema))
        if set(df.columns) != set(st.fieldNames()):
            raise ValueError(f"{self.base}: columns {sorted(set(df.columns) ^ set(st.fieldNames()))} do not fit the table")
        return df.select(*[c(f.name).cast(f.dataType).alias(f.name) for f in st.fields])

    def _done(self, tag: tuple | None) -> bool:
        """A batch counts as done when its number, or a later one, is kept."""
        if tag is None:
            return False
        seen = self.tag(tag[0])
        return seen is not None and seen >= tag[1]

    def commit(self, df: DataFrame | list[DataFrame], tag: tuple | None = None) -> int:
        """Replace the table by ``df``, or by the rows of several frames, which
        are written one after the other and published together; a conflict is
        the caller's, who may have made them from rows that are no longer the
        latest."""
        after = self.current_version()
        if self._done(tag):
            return after
        entries = [self._entry(self._write(x), x.schema) for x in _frames(df)]
        return self._publish(entries, after, tags=dict([tag]) if tag else None, schema=_frames(df)[0].schema.json())

    def append(self, df: DataFrame, tag: tuple | None = None) -> int:
        """Add rows: only they are written, once, however often other writers
        come first. ``tag`` (name, number): a batch whose number is kept with
        the table already is skipped."""
        entry = None
        for _ in range(RETRIES):
            after = self.current_version()
            if self._done(tag):
                return after
            m = self._manifest(after) or {"entries": [], "schema": None}
            if entry is None:
                df = self._fitted(df, m["schema"])
                entry = self._entry(self._write(df), df.schema)
            try:
                return self._publish([*m["entries"], entry], after, "append", self._leaves(entry), dict([tag]) if tag else None,
                                     m["schema"] or df.schema.json())
            except CommitConflict:
                continue
        raise CommitConflict(f"{self.base}: still not the latest after {RETRIES} attempts")

    def merge(self, source: DataFrame, combine, tag: tuple | None = None) -> int:
        """Replace the rows of the buckets that ``source`` touches by
        ``combine(rows of these buckets, source)``; other buckets keep their
        files. Without buckets the whole table is combined. When another
        writer was first, the rows are combined anew with its version."""
        return self._merge(source, combine, tag)

    def upsert(self, source: DataFrame | list[DataFrame], key: list[str], order_by: list[str] | None = None,
               tag: tuple | None = None) -> int:
        """``merge`` with ``upsert`` (with ``replace_keys`` without
        ``order_by``) as the functions of these names have it, but ``source`` is
        made once, keys meet as narrow rows, and where no row is replaced the
        new ones are only added: no bucket is rewritten. ``source`` may be
        several frames that share no key; they are made one after the other.
        Many bytes of buckets are combined in groups of buckets."""
        if not self.buckets:
            return self.merge(reduce(DataFrame.unionByName, _frames(source)),
                              lambda t, n: upsert(t, n, key, order_by) if order_by else replace_keys(t, n, key), tag)
        return self._merge([keep_latest(x, key, order_by) if order_by else x for x in _frames(source)],
                           lambda t, n, found: (t.join(found.filter(~c("_newer")), key, "left_anti").unionByName(
                               n.join(found.filter("_newer"), key, "left_anti").select(*t.columns))),
                           tag, lambda t, n: matched_keys(t, n, key, order_by))

    def _merge(self, source: DataFrame | list[DataFrame], combine, tag: tuple | None = None, match=None) -> int:
        """``match(rows, source)``: the keys of ``source`` that are there, with
        ``_newer`` where the table's row stays; ``combine`` gets them too, and
        is called for each group of buckets."""
        changed, work, made = None, f"staged/{uuid.uuid4().hex}", 0
        scratch = self._folder(work)

        def staged(*frames: DataFrame) -> DataFrame:
            nonlocal made
            paths = []
            for df in frames:
                made += 1
                paths.append(f"{scratch}/{made}")
                with freed_shuffles(self.spark):
                    df.write.option("compression", CODEC).parquet(paths[-1])
            return self.spark.read.schema(frames[0].schema).parquet(*paths)
        try:
            for _ in range(RETRIES):
                after = self.current_version()
                if self._done(tag):
                    return after
                m = self._manifest(after)
                if m is None or not m["entries"]:
                    return self.commit([x if m is None or not m["schema"] else self._fitted(x, m["schema"]) for x in _frames(source)], tag)
                old, names = m["entries"], StructType.fromJson(json.loads(m["schema"])).fieldNames()
                kinds = {f.name: f.dataType for f in StructType.fromJson(json.loads(m["schema"])).fields}
                if not made:
                    # Parquet holds no column without a type; a key's bucket goes by the table's type
                    source = staged(*[x.select(*[c(f.name).cast(kinds.get(f.name, StringType())).alias(f.name)
                                                 if f.dataType.typeName() == "void" or f.name in self.key else c(f.name)
                                                 for f in x.schema.fields]) for x in _frames(source)])
                if self.feed and changed is None:
                    changed = self._write(source.select(*names))
                more, groups = (), [None]
                if self.buckets:
                    touched = self._buckets_of(source)
                    if not touched:
                        return self._publish(old, after, "compact", [], dict([tag])) if tag else after
                    live = set(touched)
                    if match is not None:
                        found = staged(match(self._rows_in(old, live, m["schema"]), source))
                        more = (found,)
                        if found.filter(~c("_newer")).isEmpty():
                            live = set()
                    kept = [{**e, "buckets": [b for b in e["buckets"] if b not in live]} for e in old]
                    kept = [e for e in kept if e["buckets"]]
                    groups = [sorted(touched)]
                    if match is not None:
                        before = [x for e in old for x in self._leaves({**e, "buckets": sorted(set(e["buckets"]) & live)})]
                        n = min(len(touched), _parts_of(self._bytes([work, *before])))
                        groups = [groups[0][k::n] for k in range(n)]
                else:
                    live, kept = set(), []
                entries = []
                for group in groups:
                    rows = self.read(after) if group is None else self._rows_in(old, live & set(group), m["schema"])
                    # all touched buckets at once: nothing to leave out
                    mine = [source, *more] if len(groups) == 1 else [self._bucketed(x).filter(c(_BUCKET).isin(group)).drop(_BUCKET)
                                                                      for x in (source, *more)]
                    out = self._fitted(combine(rows, *mine), m["schema"])
                    entries.append(self._entry(self._write(out), out.schema, group))
                try:
                    return self._publish([*kept, *entries], after, "merge", [changed] if changed else None, dict([tag]) if tag else None)
                except CommitConflict:
                    continue
            raise CommitConflict(f"{self.base}: still not the latest after {RETRIES} attempts")
        finally:
            if made:
                fs, p = _fs(self.spark, scratch)
                fs.delete(p, True)

    def _buckets_of(self, rows: DataFrame) -> list[int]:
        """At most ``buckets`` numbers."""
        with freed_shuffles(self.spark):
            return [r[0] for r in self._bucketed(rows).select(_BUCKET).distinct().collect()]

    def _rows_in(self, entries: list[dict], buckets: set[int], schema: str) -> DataFrame:
        parts = [{**e, "buckets": sorted(set(e["buckets"]) & buckets)} for e in entries]
        return self._relation([x for e in parts for x in self._leaves(e)], schema)

    def drop_partition(self, column: str, value: str) -> int:
        """Unlist the folders of one partition value: nothing is written."""
        if column not in self.partition_by:
            raise ValueError(f"{self.base} is not partitioned by {column}")
        for _ in range(RETRIES):
            after = self.current_version()
            old = self._load(after) or []
            mark = f"{column}={value}"
            kept = [{**e, "leaves": [x for x in e["leaves"] if mark not in x.split("/")]} for e in old]
            if kept == old:
                return after
            try:
                return self._publish([e for e in kept if e["leaves"]], after, "drop")
            except CommitConflict:
                continue
        raise CommitConflict(f"{self.base}: still not the latest after {RETRIES} attempts")

    def partition_rows(self, column: str, value: str) -> int:
        """Rows of one partition value, from its own files' footers."""
        m = self._manifest(self.current_version())
        if m is None:
            return 0
        leaves = [x for e in m["entries"] for x in self._leaves(e) if f"{column}={value}" in x.split("/")]
        return self._relation(leaves, m["schema"]).count() if leaves else 0

    def compact(self, at_least: int = 8) -> int:
        """Write the folders of many small commits anew as one, when there are
        ``at_least``; the rows stay as they are, which ``changes`` knows.
        Appends that come meanwhile are kept."""
        first = self.current_version()
        m = self._manifest(first)
        if m is None or len(m["entries"]) < at_least:
            return first
        rows = self._relation([x for e in m["entries"] for x in self._leaves(e)], m["schema"])
        entry = self._entry(self._write(rows), rows.schema)
        for _ in range(RETRIES):
            after = self.current_version()
            now = self._load(after)
            if now[:len(m["entries"])] != m["entries"]:
                raise CommitConflict(f"{self.base}: rows were rewritten while they were compacted")
            try:
                return self._publish([entry, *now[len(m["entries"]):]], after, "compact", [])
            except CommitConflict:
                continue
        raise CommitConflict(f"{self.base}: still not the latest after {RETRIES} attempts")

    def retain(self, versions: int = 10) -> int:
        """Delete data folders that none of the latest versions lists; the
        number deleted. Run it when no commit is under way."""
        live = set()
        for v in self._manifests()[-versions:]:
            m = self._manifest(v) or {"entries": [], "changes": None}
            live |= {"/".join(x.split("/")[:2]) for x in [*(e["path"] for e in m["entries"]), *(m["changes"] or [])]}
        fs, p = _fs(self.spark, self._folder("data"))
        gone = [f.getPath() for f in fs.listStatus(p) if f"data/{f.getPath().getName()}" not in live] if fs.exists(p) else []
        for x in gone:
            fs.delete(x, True)
        return len(gone)


# ---------------------------------------------------------------------------
# Storage-level operations (each returns a small log DataFrame / dict)
# ---------------------------------------------------------------------------
def incremental_delete_insert(table: VersionedTable, source: DataFrame, key: list[str], watermark: str) -> dict:
    """K09 maintenance: first run = full build, later runs = delete+insert of
    rows newer than the table's high-water mark."""
    cur = table.read()
    if cur is None:
        table.commit(source)
        return {"mode": "full", "version": table.current_version()}
    mark = cur.agg(F.max(watermark)).first()[0]
    new = source if mark is None else source.filter(c(watermark) > F.lit(mark))
    table.merge(new.select(*cur.columns), lambda t, n: replace_keys(t, n, key))
    return {"mode": "delete+insert", "watermark": mark, "version": table.current_version()}


def incremental_merge(table: VersionedTable, source: DataFrame, key: list[str], watermark: str | None = None,
                      order_by: list[str] | None = None) -> dict:
    """K10 maintenance: keyed upsert; with ``watermark`` only rows loaded
    after the table's mark are merged (fixes the full merge every run)."""
    cur = table.read()
    if cur is None:
        table.commit(keep_latest(source, key, order_by) if order_by else source)
        return {"mode": "full", "version": table.current_version()}
    src = source
    if watermark:
        mark = cur.agg(F.max(watermark)).first()[0]
        if mark is not None:
            src = source.filter(c(watermark) > F.lit(mark))
    if not order_by:
        require_unique(src, key)
    counts = upsert_counts(cur, src, key).first()
    table.upsert(src.select(*cur.columns), key, order_by)
    return {"mode": "merge", "rows_inserted": counts["rows_inserted"], "rows_updated": counts["rows_updated"],
            "version": table.current_version()}


def _frames(df: DataFrame | list[DataFrame]) -> list[DataFrame]:
    return df if isinstance(df, list) else [df]


def _parts_of(size: int) -> int:
    """Steps for a change of ``size`` bytes."""
    return max(1, min(MAX_PARTS, -(-size // PART_BYTES)))


def split_by_key(rows: DataFrame, key: list[str], parts: int) -> list[DataFrame]:
    """``rows`` in ``parts`` frames; the rows of a key are in one of them."""
    part = F.pmod(F.xxhash64(*key), F.lit(parts))
    return [rows.filter(part == k) for k in range(parts)] if parts > 1 else [rows]


def maintain_from_changes(table: VersionedTable, feed: VersionedTable, derive, key: list[str],
                          order_by: list[str] | None = None, affected=None, by_key: bool = False) -> dict:
    """K09 / K10 maintenance from a change set: rows that versions of ``feed``
    added since the table last looked are read from their own folders, so a
    late row counts whatever its load time, and only the buckets of changed
    keys are rewritten. ``derive`` makes rows of the table from feed rows;
    ``affected(changed, all)`` widens the changed rows to all feed rows that
    must be derived anew (a patient's encounters). ``by_key``: feed rows have
    ``key`` as the rows derived from them, and those of a key are derived from
    its own feed rows alone; a large change is then made in parts of the keys,
    so that the shuffles of one part at a time are on disk. The version of the
    feed is kept with the table in the same commit."""
    name, now = f"feed:{feed.base}", feed.current_version()
    seen = table.tag(name)
    if seen == now:
        return {"mode": "unchanged", "version": table.current_version()}
    changed = feed.changes(seen, now) if seen is not None and table.exists() else None
    full = changed is None
    rows = feed.read(now) if full else changed if affected is None else affected(changed, feed.read(now))
    parts = _parts_of(feed.size(now, 0 if full else seen)) if by_key else 1
    made = [derive(x) for x in split_by_key(rows, key, parts)]
    if full:
        table.commit([keep_latest(x, key, order_by) if order_by else x for x in made], (name, now))
        return {"mode": "full", "version": table.current_version()}
    table.upsert(made, key, order_by, (name, now))
    return {"mode": "changes", "version": table.current_version()}


def capture(feed: VersionedTable, source: DataFrame) -> int:
    """Append to ``feed`` the rows of ``source`` that it does not hold yet,
    compared by all columns: for sources that only show their whole state."""
    if not feed.exists():
        return feed.append(source)
    same = F.xxhash64(*source.columns)
    held = feed.read().select(same.alias("_same"), F.struct(*source.columns).alias("_row"))
    new = (source.withColumn("_same", same).withColumn("_row", F.struct(*source.columns))
           .join(held, ["_same", "_row"], "left_anti").drop("_same", "_row"))
    return feed.append(new) if not new.limit(1).isEmpty() else feed.current_version()


def incremental_append(table: VersionedTable, source: DataFrame, ts: str, initial_since=None) -> dict:
    cur = table.read()
    new = append_new(cur, source, ts, initial_since)
    table.append(new if cur is None else new.select(*cur.columns))
    return {"mode": "append", "version": table.current_version()}


def snapshot(table: VersionedTable, incoming: DataFrame, key: str, snapshot_ts: str, **kw) -> dict:
    table.commit(scd2_snapshot(table.read(), incoming, key, snapshot_ts, **kw))
    return {"mode": "snapshot", "version": table.current_version()}


class HistoryTable:
    """Type-2 history with open and closed versions apart.

    Open versions are a table in key buckets, of which a snapshot rewrites only
    those with a changed key; closed versions are only ever appended. The
    closed rows of a run are committed first, the open ones, with the run's
    number, last: readers leave out closed rows of a run whose number the open
    table does not have yet, and a run that died is made again under the same
    number, so its closed rows are not added twice."""

    def __init__(self, spark: SparkSession, base: str, key: str, buckets: int = 64):
        self.spark, self.base, self.key = spark, base.rstrip("/"), key
        self.open = VersionedTable(spark, f"{self.base}/open", key=(key,), buckets=buckets)
        self.closed = VersionedTable(spark, f"{self.base}/closed")

    def read(self) -> DataFrame | None:
        now, run = self.open.read(), self.open.tag("snapshot")
        if now is None:
            return None
        past = self.closed.read()
        return now if past is None else now.unionByName(past.filter(c("_run") <= run).drop("_run"))

    def snapshot(self, incoming: DataFrame, snapshot_ts: str, check_cols: list[str] | None = None,
                 updated_at: str | None = None, invalidate_hard_deletes: bool = True) -> dict:
        """One run: as ``scd2_snapshot``, but only changes are written."""
        run = (self.open.tag("snapshot") or 0) + 1
        how = {"check_cols": check_cols, "updated_at": updated_at, "invalidate_hard_deletes": invalidate_hard_deletes}
        now = self.open.read()
        if now is None:
            self.open.commit(scd2_snapshot(None, incoming, self.key, snapshot_ts, **how), ("snapshot", run))
            return {"mode": "full", "run": run}
        after = scd2_snapshot(now, incoming, self.key, snapshot_ts, **how)
        # rows of the new state that the open table does not hold as they are: closed versions and new ones
        held = now.select("dbt_scd_id", F.lit(True).alias("_held"))
        delta = (after.join(held, "dbt_scd_id", "left")
                 .filter(c("_held").isNull() | c("dbt_valid_to").isNotNull()).drop("_held"))
        path = f"{self.base}/delta/{run}-{uuid.uuid4().hex}"
        delta.write.parquet(path)
        delta = self.spark.read.schema(delta.schema).parquet(path)
        if not delta.limit(1).isEmpty():
            ended = delta.filter(c("dbt_valid_to").isNotNull()).withColumn("_run", F.lit(run).cast("bigint"))
            self.closed.append(ended, ("snapshot", run))

            def replaced(rows, changed):
                fresh = changed.filter(c("dbt_valid_to").isNull()).select(*rows.columns)
                return rows.join(changed.select(self.key).distinct(), self.key, "left_anti").select(*rows.columns).unionByName(fresh)
            self.open.merge(delta.select(*now.columns), replaced, ("snapshot", run))
        fs, p = _fs(self.spark, path)
        fs.delete(p, True)
        return {"mode": "changes", "run": run}


def offboard_tenant(spark: SparkSession, tables: dict[str, VersionedTable], tenant: str) -> DataFrame:
    """Remove a tenant from each table (children first, in the given
    order) and return the evidence log: rows before / after per table. A table
    partitioned by tenant only unlists the tenant's folders."""
    rows = []
    for name, t in tables.items():
        if not t.exists():
            continue
        if "hospital_id" in t.partition_by:
            before = t.partition_rows("hospital_id", tenant)
            t.drop_partition("hospital_id", tenant)
            after = t.partition_rows("hospital_id", tenant)
        else:
            cur = t.read()
            before = cur.filter(c("hospital_id") == tenant).count()
            t.commit(remove_tenant(cur, tenant))
            after = t.read().filter(c("hospital_id") == tenant).count()
        rows.append((name, tenant, before, after))
    return spark.createDataFrame(rows, "table_name string, hospital_id string, rows_before bigint, rows_after bigint")


def backfill(table: VersionedTable, batch: DataFrame, report: DataFrame, date_column: str = "admission_date") -> DataFrame:
    """Append a validated batch only when every validation row is PASS;
    returns the summary (before/after counts, months filled, charge sum)."""
    failed = report.filter(c("status") != "PASS").count()
    cur = table.read()
    before = 0 if cur is None else cur.count()
    if failed == 0:
        table.append(batch if cur is None else batch.select(*cur.columns))
    after_df = table.read()
    summary = batch.agg(
        F.countDistinct(F.date_trunc("month", date_column)).alias("months_filled"),
        F.count(F.lit(1)).alias("batch_rows"),
        fn.r2(F.sum("total_charges")).alias("batch_total_charges"))
    return summary.select(
        F.lit(before).cast("bigint").alias("rows_before"),
        F.lit(after_df.count() if after_df is not None else 0).cast("bigint").alias("rows_after"),
        F.lit("APPLIED" if failed == 0 else "REJECTED").alias("status"), "*")
