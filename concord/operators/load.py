"""Change capture, merges and load strategies.

All functions take DataFrames and return DataFrames; nothing is written.  A
merge returns ``(new_target, changes)`` where ``changes`` is a change feed
(M3: ``_change_type`` insert/delete; an update is a delete of the old image
plus an insert of the new one).  Keyed merges are one full outer join on the
key (sort-merge; both sides shuffle on the key once), never a per-row loop.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalize as N
from .dedup import latest_change

REPLICATE_CHUNK = 4096


def _c(n: str) -> Column:
    return F.col(f"`{n}`")


def replicate(df: DataFrame, count_col: str, chunk: int = REPLICATE_CHUNK) -> DataFrame:
    """Emit each row ``count_col`` times without putting a hot row's copies in one task.

    Rows with at most ``chunk`` copies, all but a few, are expanded where they
    are, without a shuffle.  A row with more is cut into units of at most
    ``chunk`` x ``chunk`` copies, the units are spread round-robin, and each
    unit is expanded where it lands (``chunk`` rows of at most ``chunk``
    copies).  A row holding a third of all copies thus becomes many units on
    many tasks.
    """
    n = F.col(count_col)
    one = F.explode(F.array_repeat(F.lit(1), n.cast("int"))).alias("_x")
    return (df.where((n > 0) & (n <= chunk)).select("*", one).drop("_x", count_col)
            .unionByName(_replicate_hot(df.where(n > chunk), count_col, chunk)))


def _replicate_hot(df: DataFrame, count_col: str, chunk: int) -> DataFrame:
    n = F.col(count_col)
    unit = chunk * chunk
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = (df.select("*", F.explode(F.sequence(F.lit(0), F.ceil(n / unit).cast("int") - 1)).alias("_u"))
             .repartition(parts))
    in_unit = F.least(F.lit(unit), n - F.col("_u") * unit)
    chunks = (units.select("*", in_unit.alias("_nu"))
              .select("*", F.explode(F.sequence(F.lit(0), F.ceil(F.col("_nu") / chunk).cast("int") - 1)).alias("_c")))
    k = F.least(F.lit(chunk), F.col("_nu") - F.col("_c") * chunk).cast("int")
    return (chunks.select("*", F.explode(F.array_repeat(F.lit(1), k)).alias("_x"))
            .drop("_u", "_nu", "_c", "_x", count_col))


def tag_changes(df: DataFrame, change: str, version: int | None = None, ts: Column | None = None) -> DataFrame:
    out = df.select("*", F.lit(change).alias("_change_type"))
    if version is not None:
        out = out.withColumn("_commit_version", F.lit(version).cast("bigint"))
    if ts is not None:
        out = out.withColumn("_commit_timestamp", ts)
    return out


# ------------------------------------------------------------------ M1 hash merge

def hash_merge(target: DataFrame, source: DataFrame, cols: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """M1: rows with the same hash are kept, target-only rows deleted, source-only inserted; no updates.

    Multiplicity is kept (N15): a hash twice in the source and once in the
    target inserts one more copy.  One shuffle on the 128-bit fingerprint;
    each group carries one representative row.
    """
    cols = list(cols or target.columns)
    h1, h2 = N.row_fingerprint(cols)
    row = F.struct(*[_c(c) for c in cols])
    t = target.select(h1.alias("h1"), h2.alias("h2"), row.alias("row"), F.lit(1).alias("_t"), F.lit(0).alias("_s"))
    s = source.select(h1.alias("h1"), h2.alias("h2"), row.alias("row"), F.lit(0).alias("_t"), F.lit(1).alias("_s"))
    g = (t.unionByName(s).groupBy("h1", "h2")
         .agg(F.any_value("row").alias("row"), F.sum("_t").alias("t_n"), F.sum("_s").alias("s_n")))
    # one pass over the groups: (kind, copies) for kept, deleted and inserted copies, then one replication
    kinds = F.array(F.struct(F.lit("keep").alias("kind"), F.least("t_n", "s_n").alias("n")),
                    F.struct(F.lit("delete").alias("kind"), F.greatest(F.col("t_n") - F.col("s_n"), F.lit(0)).alias("n")),
                    F.struct(F.lit("insert").alias("kind"), F.greatest(F.col("s_n") - F.col("t_n"), F.lit(0)).alias("n")))
    parts = g.select("row", F.explode(kinds).alias("k")).select("row", "k.kind", "k.n")
    rows = replicate(parts, "n").select("row.*", "kind")
    new_target = rows.where(F.col("kind") != "delete").drop("kind")
    changes = rows.where(F.col("kind") != "keep").withColumnRenamed("kind", "_change_type")
    return new_target, changes


# ------------------------------------------------------------------ J13 / M2 / M3

def _changed(cols: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | ~F.col(f"t.`{c}`").eqNullSafe(F.col(f"s.`{c}`"))
    return out


def merge_split(target: DataFrame, source: DataFrame, keys: Sequence[str],
                compare_cols: Sequence[str] | None = None) -> DataFrame:
    """Full join on the key with a ``_merge`` class per key:
    matched_unchanged / matched_changed / not_matched (source only) / not_matched_by_source.

    Columns: the key, then ``t`` and ``s`` structs with the two images.
    NULL keys never match.
    """
    cols = [c for c in (compare_cols or target.columns) if c not in keys]
    t = target.select(*[_c(k).alias(f"_k_{k}") for k in keys], F.struct(*[_c(c) for c in target.columns]).alias("t"))
    s = source.select(*[_c(k).alias(f"_j_{k}") for k in keys], F.struct(*[_c(c) for c in source.columns]).alias("s"))
    cond = None
    for k in keys:
        e = F.col(f"_k_{k}") == F.col(f"_j_{k}")
        cond = e if cond is None else cond & e
    j = t.join(s, cond, "full")
    cls = (F.when(F.col("t").isNull(), "not_matched")
           .when(F.col("s").isNull(), "not_matched_by_source")
           .when(_changed(cols), "matched_changed").otherwise("matched_unchanged"))
    return j.select(*[F.coalesce(F.col(f"_k_{k}"), F.col(f"_j_{k}")).alias(k) for k in keys], "t", "s",
                    cls.alias("_merge"))


def full_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], compare_cols: Sequence[str] | None = None,
               delete_scope: Callable[[Callable[[str], Column]], Column] | None = None, version: int | None = None,
               commit_ts: Column | None = None, delete: bool = True) -> tuple[DataFrame, DataFrame]:
    """M2 full merge by key: insert new keys, update changed rows, delete vanished keys.

    ``delete_scope`` (N22) limits deletes to the rows a source slice owns; it
    is a function of a column getter, e.g. ``lambda col: col("bk").startswith("A|")``; ``delete=False`` gives the watermark load
    without deletes (M7).  Returns (new_target, change feed M3).
    """
    sp = merge_split(target, source, keys, compare_cols)
    cols = target.columns
    t_img = [F.col(f"t.`{c}`").alias(c) for c in cols]
    s_img = [F.col(f"s.`{c}`").alias(c) for c in cols]
    m = F.col("_merge")
    if delete and delete_scope is not None:
        sp = sp.withColumn("_in_scope", F.coalesce(delete_scope(lambda c: F.col(f"t.`{c}`")), F.lit(False)))
    else:
        sp = sp.withColumn("_in_scope", F.lit(delete))
    do_delete = (m == "not_matched_by_source") & F.col("_in_scope")
    new_target = (sp.where(~do_delete)
                  .select(*[F.when(m.isin("not_matched", "matched_changed"), F.col(f"s.`{c}`"))
                            .otherwise(F.col(f"t.`{c}`")).alias(c) for c in cols]))
    # one pass over the join: every key emits its delete image and/or its insert image (an update emits both)
    t_row = F.struct(*t_img, F.lit("delete").alias("_change_type"))
    s_row = F.struct(*s_img, F.lit("insert").alias("_change_type"))
    emitted = F.array(F.when(do_delete | (m == "matched_changed"), t_row),
                      F.when(m.isin("not_matched", "matched_changed"), s_row))
    changes = sp.select(F.explode(F.filter(emitted, lambda x: x.isNotNull())).alias("_c")).select("_c.*")
    if version is not None:
        changes = changes.withColumn("_commit_version", F.lit(version).cast("bigint"))
    if commit_ts is not None:
        changes = changes.withColumn("_commit_timestamp", commit_ts)
    return new_target, changes


def split_counts(split: DataFrame) -> DataFrame:
    """J13 counts: one row per ``_merge`` class."""
    return split.groupBy("_merge").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


# ------------------------------------------------------------------ M4 delta load

def delta_load(target: DataFrame, feed: DataFrame, keys: Sequence[str], start_version: int,
               version_col: str = "_commit_version", change_col: str = "_change_type",
               event_filter: Column | None = None) -> DataFrame:
    """M4: feed rows from ``start_version`` on, that version included (S13) -> latest change per key (W3) ->
    IsDelete -> apply.

    One full join of the target and the latest changes: a key with a change
    becomes its latest image, or goes when that is a delete; others stay.
    """
    f = feed.where(F.col(version_col) >= start_version)
    if event_filter is not None:
        f = f.where(event_filter)
    latest = latest_change(f, keys, version_col, change_col=change_col)
    image = F.struct(*[F.col(f"`{c}`") for c in target.columns])
    change = latest.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], image.alias("_new"),
                           (F.col(change_col) == "delete").alias("is_delete"))
    j = target.join(change, [F.col(f"`{k}`") == F.col(f"_k{i}") for i, k in enumerate(keys)], "full")
    return (j.where(~F.coalesce("is_delete", F.lit(False)))
            .select(*[F.when(F.col("_new").isNotNull(), F.col(f"_new.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c)
                      for c in target.columns]))


def is_empty(df: DataFrame) -> bool:
    """M6 first-run test: only one row (at most) is read."""
    return df.limit(1).count() == 0


def load_mode(target: DataFrame, forced_full: bool = False) -> str:
    """M6: 'full' for an empty target or a forced reload (watermark 0), else 'incremental'."""
    return "full" if forced_full or is_empty(target) else "incremental"


# ------------------------------------------------------------------ M5 conditional upsert

def conditional_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                       delete_when: Column | None = None, update_when: Column | None = None,
                       insert_when: Column | None = None) -> DataFrame:
    """M5: MERGE with ``WHEN MATCHED AND <c> THEN DELETE / UPDATE``, ``WHEN NOT MATCHED AND <c> THEN INSERT``.

    Conditions are written over the source image as ``s.<col>`` and the target
    image as ``t.<col>``.  Returns the new target.
    """
    sp = merge_split(target, source, keys)
    cols = target.columns
    matched = F.col("t").isNotNull() & F.col("s").isNotNull()
    dele = matched & (delete_when if delete_when is not None else F.lit(False))
    upd = matched & ~dele & (update_when if update_when is not None else F.lit(True))
    ins = F.col("t").isNull() & (insert_when if insert_when is not None else F.lit(True))
    keep = (F.col("t").isNotNull() & ~dele) | ins
    return sp.where(keep).select(*[F.when(upd | ins, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c)
                                   for c in cols])


# ------------------------------------------------------------------ M7-M10

def watermark_load(target: DataFrame, source: DataFrame, keys: Sequence[str], modified_col: str,
                   last_watermark: Column, delete_missing: bool = False) -> DataFrame:
    """M7: upsert source rows with ``modified > last``; never delete.
    M8 (``delete_missing=True``): also drop target keys absent from the full source key list; the list and the
    changed rows come from one pass over the source, joined once."""
    newer = F.col(modified_col) > last_watermark
    if not delete_missing:
        return full_merge(target, source.where(newer), keys, delete=False)[0]
    image = F.when(newer, F.struct(*[F.col(f"`{c}`") for c in target.columns]))
    listed = source.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], image.alias("_new"))
    same = [F.col(f"`{k}`") == F.col(f"_k{i}") for i, k in enumerate(keys)]
    held = target.select("*", F.lit(True).alias("_held"))
    j = listed.join(held, same, "left").where(F.col("_new").isNotNull() | F.col("_held"))
    return j.select(*[F.when(F.col("_new").isNotNull(), F.col(f"_new.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c)
                      for c in target.columns])


def forward_append(target: DataFrame, source: DataFrame, wm_col: str, last_watermark: Column) -> DataFrame:
    """M9: append source rows strictly after the watermark (source columns aligned to the target)."""
    return target.unionByName(source.where(F.col(wm_col) > last_watermark).select(*target.columns))


def ranged_reload(target: DataFrame, source: DataFrame, date_col: str, start: Column, end: Column) -> DataFrame:
    """Replace the target's rows in [start, end) with the source's rows of that window; rows without a date are in no
    window, so the target's stay and the source's do not come in."""
    inwin = (F.col(date_col) >= start) & (F.col(date_col) < end)
    return target.where(~F.coalesce(inwin, F.lit(False))).unionByName(source.where(inwin))


# ------------------------------------------------------------------ M11 SCD

def scd2(target: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str], as_of: Column,
         scd1: Sequence[str] = (), valid_from: str = "valid_from", valid_to: str = "valid_to",
         current: str = "is_current", deleted: str = "is_deleted") -> DataFrame:
    """SCD2 on ``tracked`` columns, SCD1 on ``scd1`` columns, hard delete -> is_deleted + close.

    ``target`` holds history rows (business columns + the four SCD columns);
    ``source`` is the current snapshot.  A returning key opens a new current
    row.  History rows (not current) pass through untouched; only the current
    rows join the snapshot (one full outer join on the key), and every key
    emits its output rows (at most a closed and an opened one) in the same
    pass over the join.
    """
    biz = [c for c in source.columns]
    is_current = F.coalesce(F.col(current), F.lit(False))  # an unset flag: history
    hist = target.where(~is_current)
    cur = target.where(is_current)
    sp = merge_split(cur, source, keys, compare_cols=list(tracked))
    m = F.col("_merge")
    t_deleted = F.coalesce(F.col(f"t.`{deleted}`"), F.lit(False))
    t_from = F.col(f"t.`{valid_from}`")
    null_ts = F.lit(None).cast("timestamp_ntz")

    def row(img: str, vf: Column, vt: Column, is_cur: Column, is_del: Column, overlay1: bool = False) -> Column:
        cols = []
        for c in biz:
            v = F.col(f"{img}.`{c}`")
            if overlay1 and c in scd1:
                v = F.coalesce(F.col(f"s.`{c}`"), v)
            cols.append(v.alias(c))
        return F.struct(*cols, vf.cast("timestamp_ntz").alias(valid_from), vt.cast("timestamp_ntz").alias(valid_to),
                        is_cur.alias(current), is_del.alias(deleted))

    returning = (m != "not_matched") & F.col("s").isNotNull() & t_deleted
    emitted = F.array(
        # unchanged current row (SCD1 columns overwritten in place)
        F.when((m == "matched_unchanged") & ~t_deleted, row("t", t_from, null_ts, F.lit(True), F.lit(False), True)),
        # changed or returning: close the old version ...
        F.when(((m == "matched_changed") & ~t_deleted) | returning, row("t", t_from, as_of, F.lit(False), t_deleted)),
        # ... and open the new one (also for new keys)
        F.when((m == "matched_changed") | (m == "not_matched") | returning,
               row("s", as_of, null_ts, F.lit(True), F.lit(False))),
        # vanished: close and mark deleted once; an already deleted key stays as it is
        F.when((m == "not_matched_by_source") & ~t_deleted, row("t", t_from, as_of, F.lit(False), F.lit(True))),
        F.when((m == "not_matched_by_source") & t_deleted, row("t", t_from, null_ts, F.lit(True), F.lit(True))))
    out = sp.select(F.explode(F.filter(emitted, lambda x: x.isNotNull())).alias("_r")).select("_r.*")
    return hist.select(*out.columns).unionByName(out)


def scd2_initial(source: DataFrame, as_of: Column, valid_from: str = "valid_from", valid_to: str = "valid_to",
                 current: str = "is_current", deleted: str = "is_deleted") -> DataFrame:
    return source.select("*", as_of.alias(valid_from), F.lit(None).cast("timestamp_ntz").alias(valid_to),
                         F.lit(True).alias(current), F.lit(False).alias(deleted))


# ------------------------------------------------------------------ M12-M14, J11, F23, P11

def stub_members(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                 defaults: dict[str, Column] | None = None) -> DataFrame:
    """One stub dimension row per fact key missing from the dimension (late-arriving members)."""
    missing = (fact.select(F.col(fact_key).alias(dim_key)).where(F.col(dim_key).isNotNull()).distinct()
               .join(dim.select(dim_key), dim_key, "left_anti"))
    fields = [f for f in dim.schema.fields if f.name != dim_key]
    d = defaults or {}
    return missing.select(dim_key, *[d.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def first_seen(existing: DataFrame, batch: DataFrame, keys: Sequence[str], seen_col: str = "first_seen",
               ingest_time: Column | None = None) -> DataFrame:
    """First-seen snapshot time per key = least(existing, this batch's ingest time)."""
    b = batch.select(*keys, (ingest_time if ingest_time is not None else F.current_timestamp()).alias("_new"))
    b = b.groupBy(*keys).agg(F.min("_new").alias("_new"))
    j = existing.select(*keys, F.col(seen_col).alias("_old")).join(b, list(keys), "full")
    return j.select(*keys, F.least("_old", "_new").alias(seen_col))


def hot_slice(df: DataFrame, date_col: str, as_of: Column, months: int = 6) -> DataFrame:
    """Rows of the last ``months`` months before ``as_of``."""
    return df.where(F.col(date_col) >= F.add_months(as_of, -months))


def guarded_dim_join(fact: DataFrame, dim: DataFrame, fact_sk: str, dim_sk: str,
                     attrs: Sequence[str], default: object = "Unknown") -> DataFrame:
    """``LEFT JOIN dim ON sk = sk AND (sk > 0 OR sk IS NULL)`` with defaults on a miss (F8).

    The guard is applied to the dimension before the join (pushed into its
    scan).  The join strategy is left to adaptive execution.  Fact rows whose
    key cannot match (NULL, zero or negative: often the unknown member of much
    of the fact) get a negative key from a hash of the row, which spreads them.
    """
    d = dim.where(F.col(dim_sk) > 0).select(F.col(dim_sk).alias("_dsk"), *attrs)
    spread = -1 - F.abs(F.hash(*fact.columns).cast("long"))
    key = F.when(F.col(fact_sk) > 0, F.col(fact_sk).cast("long")).otherwise(spread)
    f = fact.select("*", key.alias("_fsk"))
    j = f.join(d, f["_fsk"] == d["_dsk"], "left")
    return j.select(*[f[c] for c in fact.columns],
                    *[F.coalesce(d[a], F.lit(default)).alias(a) for a in attrs])


def surrogate_key(instance: Column | str | None, business_keys: Sequence[str], null_token: str = "-1",
                  algorithm: str = "xxhash64") -> Column:
    """hash of ``'instance|bk1|bk2'`` with NULL business keys replaced by '-1' first.

    ``algorithm="md5"`` gives the hex digest instead of a bigint.
    """
    parts = ([F.lit(instance) if isinstance(instance, str) else instance] if instance is not None else [])
    parts += [F.coalesce(F.col(c).cast("string"), F.lit(null_token)) for c in business_keys]
    text = F.concat_ws("|", *parts)
    return F.md5(text) if algorithm == "md5" else F.xxhash64(text)


def add_system_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Technical columns (source, load time, validity, quality mark), under the caller's names."""
    return df.withColumns(dict(columns))
