"""Who wrote how much: per file, per function, per trailer, per identity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

COLOURS = 67


def by_commit(tokens: DataFrame, keys: tuple[str, ...] = ("file_path",)) -> DataFrame:
    """Tokens counted by file and commit: (keys, commit_sha, tokens, first_index), of code tokens and declarations. Joined
    with what is known of commits in place of tokens, a commit that wrote a whole tree is a row a file, not a row a token."""
    code = F.col("is_structural") == 0
    return tokens.filter("is_structural = 0 OR token_type = 'DECL'").groupBy(*keys, "commit_sha").agg(F.count_if(code).alias("tokens"), F.min("token_index").alias("first_index"))


def _pairs(rows: DataFrame, keys: tuple[str, ...] = ("file_path",)) -> DataFrame:
    """Rows of tokens, or of by_commit, with persons as (keys, commit_sha, person, tokens, first_index)."""
    rows = rows.withColumn("person", F.coalesce("personname", "personid", F.lit("Unknown")))
    return rows.select(*keys, "commit_sha", "person", "tokens", "first_index") if "first_index" in rows.columns else by_commit(rows, (*keys, "person"))


def top_contributors(rows: DataFrame) -> DataFrame:
    """Code tokens of each person in each file, of tokens or by_commit rows with persons. Rows are in no order."""
    return _pairs(rows).filter("tokens > 0").groupBy("file_path", "person").agg(F.sum("tokens").alias("tokens"))


def _shares(grouped: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys)
    return grouped.withColumn("token_pct", F.round(F.try_divide(100 * F.col("tokens"), F.sum("tokens").over(w)), 2)).withColumn("commit_pct", F.round(F.try_divide(100 * F.col("commits"), F.sum("commits").over(w)), 2))


def file_report(rows: DataFrame) -> DataFrame:
    """Tokens and commits of each person in each file with shares; the commits' total counts persons apart. A person
    of declarations alone is listed with no tokens."""
    g = _pairs(rows).groupBy("file_path", "person").agg(F.sum("tokens").alias("tokens"), F.countDistinct(F.when(F.col("tokens") > 0, F.col("commit_sha"))).alias("commits"))
    return _shares(g, ["file_path"])


def functions_of(rows: DataFrame) -> DataFrame:
    """Adds func_no: the number of begin_function lines so far, null outside. A begin inside restarts the count."""
    w = Window.partitionBy("file_path").orderBy("token_index")
    begun = F.sum((F.col("token_type") == "begin_function").cast("int")).over(w)
    last = F.last(F.when(F.col("token_type").isin("begin_function", "end_function"), F.col("token_type")), True).over(w)
    return rows.withColumn("func_no", F.when(last == "begin_function", begun).cast("long"))


def function_tokens(rows: DataFrame) -> DataFrame:
    """The code tokens inside functions, with func_no."""
    return functions_of(rows).filter("func_no IS NOT NULL AND is_structural = 0")


def function_report(rows: DataFrame) -> DataFrame:
    """Tokens and commits of each person in each function with shares, of tokens with persons, or of by_commit rows of
    function_tokens."""
    keys = ("file_path", "func_no")
    g = _pairs(rows if "first_index" in rows.columns else function_tokens(rows), keys).groupBy(*keys, "person").agg(F.sum("tokens").alias("tokens"), F.countDistinct("commit_sha").alias("commits"))
    return _shares(g, list(keys))


def ranked(report: DataFrame, keys: list[str]) -> DataFrame:
    """A report with place: its rows of one file or function from most to fewest tokens, equal ones by name."""
    return report.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("tokens"), "person")))


def with_totals(report: DataFrame, keys: list[str]) -> DataFrame:
    """A report in its order, with a last row Total for each file or function: tokens and commits summed over persons."""
    rows = ranked(report, keys)
    hundred = F.lit(100.0)
    total = rows.groupBy(*keys).agg(F.lit("Total").alias("person"), F.sum("tokens").alias("tokens"), F.sum("commits").alias("commits"), F.max(F.when(F.col("token_pct").isNotNull(), hundred)).alias("token_pct"), F.max(F.when(F.col("commit_pct").isNotNull(), hundred)).alias("commit_pct"), (F.max("place") + 1).alias("place"))
    return rows.unionByName(total.select(*rows.columns))


def reviewers(wide: DataFrame) -> DataFrame:
    """Commits that each reviewer's trailer stands in: a commit counts once, however many tokens it has."""
    each = wide.select("original_commit_sha", F.explode("footer_reviewed_by").alias("reviewer")).distinct()
    return each.groupBy("reviewer").agg(F.count(F.lit(1)).alias("commits"))


def author_counts(rows: DataFrame) -> DataFrame:
    """Tokens by author as written and by unified person, of the dataset, or of by_commit rows with persons (autname,
    personname, personid). The rows are read once."""
    if "first_index" in rows.columns:
        counts = rows.select(F.col("autname").alias("author_name"), F.coalesce("personname", "personid").alias("person_name"), "tokens").filter("tokens > 0")
    else:
        counts = rows.filter("is_structural = 0").select("author_name", "person_name", F.lit(1).cast("long").alias("tokens"))
    counts = counts.groupBy("author_name", "person_name").agg(F.sum("tokens").alias("tokens"))
    both = F.array(F.struct(F.lit("raw").alias("kind"), F.col("author_name").alias("name")), F.struct(F.lit("unified").alias("kind"), F.coalesce("person_name", F.lit("Unknown")).alias("name")))
    return counts.select(F.inline(both), "tokens").groupBy("kind", "name").agg(F.sum("tokens").alias("tokens"))


def colours(rows: DataFrame) -> DataFrame:
    """A colour number for each author of a file, by the order in which they first appear, and a background."""
    first = _pairs(rows).groupBy("file_path", "person").agg(F.min("first_index").alias("first_index"))
    i = F.row_number().over(Window.partitionBy("file_path").orderBy("first_index", "person"))
    out = first.withColumn("colour", (i % COLOURS).cast("int"))
    return out.withColumn("background", F.when(3 * F.col("colour") % 4 == 0, 255).otherwise(3 * F.col("colour") % 64 + 191).cast("int"))


def line_anchors(rows: DataFrame) -> DataFrame:
    """L anchors number the lines that are no declarations; R anchors stand where the source line changes."""
    w = Window.partitionBy("file_path").orderBy("token_index")
    out = rows.filter("token_type <> 'DECL'").withColumn("l_anchor", F.concat(F.lit("L"), F.row_number().over(w)))
    return out.withColumn("r_anchor", F.when(~F.col("source_line").eqNullSafe(F.lag("source_line").over(w)), F.concat(F.lit("R"), F.col("source_line"))))
