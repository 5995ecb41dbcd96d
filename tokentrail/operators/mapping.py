"""The maps of a rewrite (blobs, trees, commits, refs, meta): lookups, merges, guards and maintenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as fn

TOKENIZED = "orig_blob <> new_blob"
#: Bytes from which on a blob is not looked at.
OVERSIZED = 50 << 20
# Blobs on which a parser is known not to end.
DENIED = """5460d43f1884e3be230e02215151b9b963844a48 720914b27e170b73b38ef662fb04239273dd0a34
99c191e9a208547f5c9b1224c290f106a640de59 dbb885e0bf046755c4fcfbddfc2454f90c550c62""".split()


def insert_or_ignore(old: DataFrame, new: DataFrame, key: list[str], order: str = "processed_at") -> DataFrame:
    """Old rows win; of new rows with one key, the first in order."""
    add = new.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(order))).filter("_n = 1").drop("_n")
    return old.unionByName(add.join(old.select(*key), key, "left_anti"))


def insert_or_replace(old: DataFrame, new: DataFrame, key: list[str], order: str = "processed_at") -> DataFrame:
    last = new.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(order)))).filter("_n = 1").drop("_n")
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(last)


def merged_shards(parts: list[DataFrame], key: list[str]) -> DataFrame:
    """Maps of shards as one: rows of one key are equal, so any of them stays."""
    return reduce(DataFrame.unionByName, parts).dropDuplicates(key)


def row_counts(blob_map: DataFrame, tree_map: DataFrame | None = None, commit_map: DataFrame | None = None, ref_map: DataFrame | None = None) -> DataFrame:
    """Rows by class: tokenized and identity blobs, and those of the other maps that are given."""
    out = blob_map.agg(F.count_if(F.expr(TOKENIZED)).alias("tokenized"), F.count_if(~F.expr(TOKENIZED)).alias("identity"))
    for name, df in (("trees", tree_map), ("commits", commit_map), ("refs", ref_map)):
        if df is not None:
            out = out.crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias(name))))  # one row each
    return out


def tokenized_for(blob_map: DataFrame, extensions: list[str]) -> DataFrame:
    return blob_map.filter(TOKENIZED).filter(fn.has_extension(F.col("path"), extensions))


def stride_sample(blob_map: DataFrame, size: int, exclude: list[str] | None = None) -> DataFrame:
    """size rows spread evenly over the tokenized ones in order of (orig_blob, path); numbers come from ranges of the order,
    as many as the session shuffles by."""
    from .ordering import numbered

    rows = blob_map.filter(TOKENIZED).select("orig_blob", "path", "new_blob")
    if exclude:
        rows = rows.filter(~fn.has_extension(F.col("path"), exclude))
    place = numbered(rows, ["orig_blob", "path"], "rn")
    step = max(1, place.count() // size)
    return place.filter((F.col("rn") % step == 0) & (F.col("rn") < step * size)).select("orig_blob", "path", "new_blob")


def first_narrowed_path(blob_map: DataFrame, new_mask: str) -> DataFrame:
    """The first tokenized path, if any, that a new mask would no longer match."""
    return blob_map.filter(TOKENIZED).filter(~F.col("path").rlike(new_mask)).orderBy("path").limit(1).select("path")


def lookup(tasks: DataFrame, main: DataFrame, warm: DataFrame | None = None) -> DataFrame:
    """(orig_blob, path) with what is known: hit, warm (from a read-only second map) or miss."""
    out = tasks.join(main.select("orig_blob", "path", F.col("new_blob").alias("_m")), ["orig_blob", "path"], "left")
    if warm is None:
        return out.select("orig_blob", "path", F.col("_m").alias("new_blob"), F.when(F.col("_m").isNull(), "miss").otherwise("hit").alias("found"))
    out = out.join(warm.select("orig_blob", "path", F.col("new_blob").alias("_w")), ["orig_blob", "path"], "left")
    return out.select("orig_blob", "path", F.coalesce("_m", "_w").alias("new_blob"), F.when(F.col("_m").isNotNull(), "hit").when(F.col("_w").isNotNull(), "warm").otherwise("miss").alias("found"))


def screened(blobs: DataFrame, denied: list[str] | DataFrame | None, limit: int, failed: DataFrame | None = None) -> DataFrame:
    """Adds exclusion: denylisted, oversized, why it failed before, or null. denied: ids in any case, a list or a table
    (object_id); None stands for the list that is known."""
    if isinstance(denied, DataFrame):
        deny = denied.select(F.lower("object_id").alias("_d")).distinct()
        out = blobs.join(deny, F.lower("orig_blob") == F.col("_d"), "left").withColumn("exclusion", F.when(F.col("_d").isNotNull(), "denylisted")).drop("_d")
    else:
        ids = [d.lower() for d in (DENIED if denied is None else denied)]
        out = blobs.withColumn("exclusion", F.when(F.lower("orig_blob").isin(ids) if ids else F.lit(False), "denylisted"))
    out = out.withColumn("exclusion", F.coalesce("exclusion", F.when(F.col("size") >= limit, "oversized")))
    if failed is None:
        return out
    # a blob that failed at a path is tried once in a run
    why = F.max("reason") if "reason" in failed.columns else F.lit("failed")
    bad = failed.groupBy("orig_blob", "path").agg(why.alias("_f"))
    return out.join(bad, ["orig_blob", "path"], "left").withColumn("exclusion", F.coalesce("exclusion", "_f")).drop("_f")


def exclusion_report(rows: DataFrame) -> DataFrame:
    return rows.filter("exclusion IS NOT NULL").groupBy("exclusion").agg(F.countDistinct("orig_blob", "path").alias("blobs"))


def outcome(killed: Column, status: Column, out: Column, source: Column, abort: bool = False) -> Column:
    """What a tokenizer's end means for its blob."""
    crash = (status == 33) | (status > 128) | ((status == 0) & (F.length(out) == 0) & (F.length(source) > 0))
    return F.when(killed, "timeout").when(crash, "parser-crash").when(status != 0, "abort" if abort else "tokenizer-error").when(out == source, "skip").otherwise("replace")


def outcome_of(killed: bool, status: int, out: bytes, source: bytes, abort: bool = False) -> str:
    """outcome of one run."""
    if killed:
        return "timeout"
    if status == 33 or status > 128 or status < 0 or (status == 0 and not out and source):
        return "parser-crash"
    if status:
        return "abort" if abort else "tokenizer-error"
    return "skip" if out == source else "replace"


def memoised(blobs: DataFrame, memo: DataFrame, tokenize) -> DataFrame:
    """(content_sha, ext, status, tokens) for each content: those in memo (content_sha, ext, tokens) are reused, others
    are tokenized once, however many paths have them. tokenize turns (content_sha, ext, content) rows into result rows."""
    asked = blobs.select("content_sha", "ext", "content").dropDuplicates(["content_sha", "ext"])
    new = asked.join(memo.select("content_sha", "ext"), ["content_sha", "ext"], "left_anti")
    old = memo.join(asked.select("content_sha", "ext"), ["content_sha", "ext"], "left_semi")
    return old.select("content_sha", "ext", F.lit("ok").alias("status"), "tokens").unionByName(tokenize(new).select("content_sha", "ext", "status", "tokens"))


def append_memo(results: DataFrame, path: str) -> None:
    """Keeps what was tokenized well, and nothing else, in a Parquet memo by the first byte of the content's hash."""
    good = results.filter("status = 'ok'").select("content_sha", "ext", "tokens").withColumn("fan", F.substring("content_sha", 1, 2))
    good.write.mode("append").partitionBy("fan").parquet(path)


def read_memo(spark, path: str) -> DataFrame:
    """(content_sha, ext, tokens); a memo that is not there yet is empty."""
    from ..store import _path

    p, fs = _path(spark, path)
    if not fs.exists(p):
        return spark.createDataFrame([], "content_sha string, ext string, tokens array<string>")
    return spark.read.parquet(path).dropDuplicates(["content_sha", "ext"]).select("content_sha", "ext", "tokens")


def widened(blob_map: DataFrame, old_mask: str, new_mask: str, objects: DataFrame | None = None, sample: int = 256) -> DataFrame:
    """After a mask grows: tokenized rows stay, identity rows go so that they are looked at again; the other maps start
    anew (see emptied). Refused: a mask that would lose a tokenized path, and a sampled row whose new blob the target's
    objects lack. Equal masks change nothing."""
    if old_mask == new_mask:
        return blob_map
    lost = first_narrowed_path(blob_map, new_mask).first()
    if lost:
        raise ValueError(f"the new mask no longer matches {lost.path}")
    _refuse_dangling(blob_map, objects, sample, None)
    return blob_map.filter(TOKENIZED)


def _refuse_dangling(blob_map: DataFrame, objects: DataFrame | None, sample: int, exclude: list[str] | None) -> None:
    if objects is not None:
        lost = dangling(stride_sample(blob_map, sample, exclude), objects).first()
        if lost:
            raise ValueError(f"the target lacks {lost.new_blob}, of {lost.path}")


def retokenized(blob_map: DataFrame, extensions: list[str], changed: list[str], objects: DataFrame | None = None, purge: dict | None = None, own_memo: bool = True, sample: int = 256) -> DataFrame:
    """Without the rows of extensions whose tokenizer changed; the other maps start anew (see emptied). Refused: changed
    extensions that are not named, names without any row, a sampled row that stays whose new blob the target lacks, and
    a purge (see purge_report) that found nothing in a memo that is not the tokenizer's own."""
    left = sorted(set(changed) - set(extensions))
    if left:
        raise ValueError(f"tokenizers of {left} changed too")
    if tokenized_for(blob_map, extensions).isEmpty():
        raise ValueError("no tokenized rows have these extensions")
    _refuse_dangling(blob_map, objects, sample, extensions)
    if purge and purge["examined"] and not purge["deleted"] and not own_memo:
        raise ValueError(f"the memo has none of {purge['examined']} contents; it is another project's")
    return blob_map.filter(f"NOT ({TOKENIZED})").unionByName(blob_map.filter(TOKENIZED).filter(~fn.has_extension(F.col("path"), extensions)))


def emptied(maps: dict[str, DataFrame], blob_map: DataFrame) -> dict[str, DataFrame]:
    """The maps after maintenance: trees name blobs, commits trees and refs commits, so these three start anew."""
    return {k: blob_map if k == "blob_map" else v.limit(0) for k, v in maps.items()}


def purged(memo: DataFrame, blob_map: DataFrame, blobs: DataFrame, extensions: list[str]) -> DataFrame:
    """The memo without the contents that tokenized rows of these extensions have, under any extension."""
    gone = tokenized_for(blob_map, extensions).select("orig_blob").distinct().join(blobs.select(F.col("object_id").alias("orig_blob"), F.sha1("content").alias("content_sha")), "orig_blob")
    return memo.join(gone.select("content_sha").distinct(), "content_sha", "left_anti")


def tokenizer_identity(parts: dict[str, list[bytes]]) -> dict[str, str]:
    """For each extension the digest of its tokenizer's components, by the digests of each, a line apiece."""
    import hashlib

    return {ext: hashlib.sha256("\n".join(hashlib.sha256(p).hexdigest() for p in each).encode()).hexdigest() for ext, each in parts.items()}


def identity_digests(components: DataFrame) -> DataFrame:
    """(ext, digest) from (ext, seq, content): tokenizer_identity as a table."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("seq", F.sha2("content", 256).alias("d")))), lambda x: x["d"])
    return components.groupBy("ext").agg(F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("digest"))


def parse_identity(text: str) -> dict[str, str]:
    """ext=hex,... of 8 to 128 digits; repeats are refused."""
    out: dict[str, str] = {}
    for part in filter(None, text.split(",")):
        ext, _, digest = part.partition("=")
        if not fn.re.fullmatch("[a-z0-9+]+", ext) or not fn.re.fullmatch("[0-9a-f]{8,128}", digest) or ext in out:
            raise ValueError(f"not an identity: {part!r}")
        out[ext] = digest
    return out


def render_identity(identity: dict[str, str]) -> str:
    return ",".join(f"{e}={d}" for e, d in sorted(identity.items()))


def identity_changes(stored: DataFrame, asked: DataFrame, blob_map: DataFrame) -> DataFrame:
    """(ext, stored, asked) where a tokenizer differs from the one recorded and cached rows depend on it."""
    used = blob_map.filter(TOKENIZED).select(fn.extension(F.col("path")).alias("ext")).distinct()
    both = stored.withColumnRenamed("digest", "stored").join(asked.withColumnRenamed("digest", "asked"), "ext").filter("stored <> asked")
    return both.join(used, "ext", "left_semi")


def purge_report(blobs: DataFrame, memo: DataFrame) -> DataFrame:
    """What a purge of these originals finds: blobs examined, memo entries deleted, missing, and unreadable blobs."""
    hits = blobs.join(memo.select("content_sha", F.lit(True).alias("_m")), "content_sha", "left")
    return hits.agg(F.count(F.lit(1)).alias("examined"), F.count_if("_m").alias("deleted"), F.count_if(F.col("_m").isNull() & F.col("content_sha").isNotNull()).alias("missing"), F.count_if(F.col("content_sha").isNull()).alias("unreadable"))


def dangling(blob_map: DataFrame, objects: DataFrame) -> DataFrame:
    """Tokenized rows whose new blob the target lacks; maintenance needs none."""
    return blob_map.filter(TOKENIZED).join(objects.select(F.col("object_id").alias("new_blob")), "new_blob", "left_anti")


def meta_guard(stored: dict[str, str], key: str, value: str) -> None:
    if stored.get(key, value) != value:
        raise ValueError(f"{key} was {stored[key]!r} when the map was made; now it is {value!r}")


def warm_maps(maps: dict[str, DataFrame], meta: dict[str, str], command: str, mask: str) -> dict[str, DataFrame]:
    """The blob and tree maps of an earlier run, to be asked where the own ones have nothing; its commits are never
    taken. Refused if its command or mask differ: its ids would be another run's."""
    for key, value in (("command", command), ("mask", mask)):
        if meta.get(key) != value:
            raise ValueError(f"the warm map's {key} is {meta.get(key)!r}, not {value!r}")
    return {k: maps[k] for k in ("blob_map", "tree_map")}


def in_flight(blobs: DataFrame, now: int, most: int = 16) -> DataFrame:
    """The blobs (label, started) that have been worked on longest, with their seconds."""
    return blobs.select("label", (F.lit(now) - F.col("started")).alias("seconds")).orderBy(F.desc("seconds"), "label").limit(most)


def largest_first(files: DataFrame) -> DataFrame:
    """(file_path, size, place): large files first, equal ones in the order of listing (ordinal), so that the last task
    to start is a short one. place is the number in that order; tasks are dealt by it."""
    from .ordering import numbered

    return numbered(files, [F.desc("size"), "ordinal"], "place").select("file_path", "size", "place")
