"""A repository's history as tables, out of its objects: commits, parents, logs and trailers, without a log command.

Only commits that a ref reaches are taken, as a log of all refs has them; they are found from the refs by doubling: each
round, a commit is joined with all that was found behind it so far. Names and messages are decoded by the commit's own
encoding. Trailers are the lines `key: value` of a message's last paragraph, lines that begin with white space go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as fn
from ..store import stored
from . import git, packs

_PERSON = r"(?s)^(.*?) ?<([^>]*)> ?(-?[0-9]+)? ?([-+][0-9]{4})?$"
#: A line that makes a paragraph trailers; others are taken along with it.
_TRAILER = r"^[A-Za-z0-9-]+[ \t]*:"


def _text(c: str) -> Column:
    """Bytes as text, by the commit's encoding where it is one that Spark knows, else UTF-8 with damage replaced."""
    latin = F.upper(F.col("encoding").cast("string")).isin("ISO-8859-1", "ISO8859-1", "LATIN1", "LATIN-1")
    return F.when(latin, F.decode(F.col(c), "ISO-8859-1")).otherwise(F.make_valid_utf8(F.col(c).cast("string")))


def reached(tips: DataFrame, parents: DataFrame, rounds: int = 64) -> DataFrame:
    """(cid) of the commits that tips (cid) reach over parents (cid, idx, parent), themselves included.

    steps holds jumps of one length, all ways of it: after round k, 2^k generations. What is reached within them is joined
    with the jumps, then jumps with jumps, so rounds grow with the logarithm of the longest way. Jumps are followed from
    what is reached only along first parents, where there is one of each length for a commit; other parents are tips."""
    first = stored(parents.groupBy("cid").agg(F.min_by("parent", "idx").alias("to")), "first")
    other = stored(parents.join(first, "cid").filter("parent <> to").select("cid", "parent").distinct(), "other")
    jumps = [first]
    while not jumps[-1].isEmpty() and len(jumps) < rounds:
        last = jumps[-1]
        jumps.append(stored(last.join(last.select(F.col("cid").alias("to"), F.col("to").alias("on")), "to").select("cid", F.col("on").alias("to")), "jumps"))
    found = new = stored(tips.select("cid").distinct(), "reached")
    while not new.isEmpty():
        line = new
        for jump in jumps[:-1][::-1]:  # from the longest down: every distance is a sum of these
            line = stored(line.unionByName(line.join(jump, "cid").select(F.col("to").alias("cid"))).distinct(), "line")
        line = line.join(found.join(new, "cid", "left_anti"), "cid", "left_anti")
        found = stored(found.unionByName(line).distinct(), "reached")
        new = stored(found.join(other, "cid").select(F.col("parent").alias("cid")).distinct().join(found, "cid", "left_anti"), "new")
    return found


def tables(found: DataFrame, tips: DataFrame | None = None, zone: str = "UTC") -> dict[str, DataFrame]:
    """commits, parents, logs and footers of commit objects (git.commit_objects); one trailing space of a name goes.
    tips: the commits (cid) that refs name, if only what these reach is wanted. Dates are in the session's time zone, of
    which zone is the name."""
    every = found.select("cid", F.posexplode("parents").alias("idx", "parent"))
    if tips is not None:
        found = found.join(reached(tips, every), "cid", "left_semi")
    date = lambda who: F.date_format(F.convert_timezone(None, F.lit(zone), F.timestamp_seconds(F.regexp_extract(who, _PERSON, 3).cast("long")).cast("timestamp_ntz")), "yyyy-MM-dd HH:mm:ss")
    author, committer, message = _text("author"), _text("committer"), _text("message")
    part = lambda who, i: F.regexp_extract(who, _PERSON, i)
    named = {"autname": fn.without_last_space(part(author, 1)), "autemail": part(author, 2), "autdate": date(author), "comname": fn.without_last_space(part(committer, 1)), "comemail": part(committer, 2), "comdate": date(committer)}
    subject = F.replace(F.regexp_extract(F.regexp_replace(message, r"^\s*\n", ""), r"(?s)^(.*?)(?:\n[ \t]*\n.*)?\n*$", 1), F.lit("\n"), F.lit(" "))
    commits = found.select("cid", *(c.alias(n) for n, c in named.items()), F.rtrim(subject).alias("summary"), (F.size("parents") > 1).alias("ismerge"))
    logs = found.select("cid", message.alias("log"))
    # the last paragraph, if it is not the first and its first line is a trailer; lines that go on are joined
    last = F.regexp_extract("log", r"(?s)\n[ \t]*\n((?:(?!\n[ \t]*\n).)+?)\s*$", 1)
    lines = logs.filter(last.rlike(_TRAILER)).select("cid", F.posexplode(F.filter(F.split(F.regexp_replace(last, r"\n[ \t]+", " "), "\n"), lambda x: x.rlike(_TRAILER))).alias("idx", "line"))
    footers = lines.select("cid", "idx", F.rtrim(F.regexp_extract("line", r"^([^:]*):", 1)).alias("key"), F.trim(F.regexp_extract("line", r"(?s)^[^:]*:(.*)$", 1)).alias("value"))
    return {"commits": commits, "parents": every if tips is None else found.select("cid", F.posexplode("parents").alias("idx", "parent")), "logs": logs, "footers": footers}


def history(spark: SparkSession, path: str, zone: str = "UTC") -> dict[str, DataFrame]:
    """The tables of the repository whose objects and refs are at path."""
    found = stored(packs.objects(spark, path).filter("kind IN ('commit', 'tag')"), "objects")
    refs = git.refs(spark, path).filter("object_id IS NOT NULL").select("object_id")
    tags = git.tag_objects(found).select(F.col("tag_id").alias("object_id"), "target")
    tips = refs
    for _ in range(8):  # a tag of a tag of a commit
        tips = tips.join(tags, "object_id", "left").select(F.coalesce("target", "object_id").alias("object_id"))
    return tables(stored(git.commit_objects(found), "commits"), tips.withColumnRenamed("object_id", "cid"), zone)
