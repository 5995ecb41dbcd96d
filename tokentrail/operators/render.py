"""HTML of annotated sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as fn
from ..store import write_files
from . import contributors

# Link functions by repository tag.
LINKS = {"p": "windowPre", "b": "windowBit", "l": "windowLin"}


def token_span(text: Column, original: Column, repo: Column, colour: Column, title: Column) -> Column:
    link = F.lit("window")
    for tag, name in LINKS.items():
        link = F.when(repo == tag, name).otherwise(link)
    return F.concat(F.lit('<span class="c'), colour, F.lit('" title="'), fn.html_escape(title), F.lit('" onclick="'), link, F.lit("('"), original, F.lit("')\">"), fn.html_escape(text), F.lit("</span>"))


def expanded(template: Column, filename: Column, dirname: Column, version: Column, url: Column) -> Column:
    """A header or footer with its four placeholders filled in."""
    for name, value in (("FILENAME", filename), ("DIRNAME", dirname), ("VERSION", version), ("REPO_URL", url)):
        template = F.replace(template, F.lit(f"_{name}_"), value)
    return template


def pages(rows: DataFrame, colours: DataFrame, header: str = "<html><title>_FILENAME_</title><pre>", footer: str = "</pre></html>", version: str = "", url: str = "") -> DataFrame:
    """(file_path, html): spans of all code tokens in order, declarations as anchors. rows has the columns of the
    dataset's source tokens with personname, personid, original and repo."""
    person = F.coalesce("personname", "personid", F.lit("Unknown"))
    own = colours.filter("person IS NOT NULL").groupBy("file_path").agg(F.map_from_entries(F.collect_list(F.struct("person", "colour"))).alias("colours"))
    # what moves by file are tokens and what is known of them: spans, which are many times as long, are made behind that
    parts = F.struct("token_index", "token_type", "token_value", "is_structural", "source_text", "original", "repo", person.alias("person"), "autdate", "summary")
    g = rows.groupBy("file_path").agg(F.collect_list(parts).alias("tokens")).join(own, "file_path", "left")

    def piece(x: Column) -> Column:
        title = F.concat_ws(";", x["original"], x["person"], x["autdate"], x["summary"])
        colour = F.coalesce(F.try_element_at("colours", x["person"]), F.lit(0)).cast("string")
        span = token_span(x["source_text"], x["original"], x["repo"], colour, title)
        return F.when(x["token_type"] == "DECL", F.concat(F.lit('<a name="'), F.element_at(F.split(x["token_value"], r"\|"), -1), F.lit('"></a>'))).when(x["is_structural"] == 0, span).otherwise("")

    g = g.select("file_path", F.array_join(F.transform(F.array_sort("tokens"), piece), "").alias("body"))
    path = F.col("file_path")
    ends = [expanded(F.lit(x), fn.basename(path), F.regexp_replace(path, "/?[^/]*$", ""), F.lit(version), F.lit(url)) for x in (header, footer)]
    return g.select("file_path", F.concat(ends[0], "body", ends[1]).alias("html"))


def table_html(report: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, table): the contributors of each file or function as an HTML table with its total row."""
    cell = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    share = lambda c: F.format_string("%.2f%%", F.coalesce(c, F.lit(0.0)).cast("double"))
    row = F.concat(F.lit("<tr>"), cell(fn.html_escape(F.col("person"))), cell(F.col("tokens").cast("string")), cell(share(F.col("token_pct"))), cell(F.col("commits").cast("string")), cell(share(F.col("commit_pct"))), F.lit("</tr>"))
    rows = contributors.with_totals(report, keys).withColumn("row", row)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "row"))), lambda x: x["row"]), "")
    head = F.lit("<tr><th>Person</th><th>Tokens</th><th>Prop.Toks</th><th>Commits</th><th>CommitProp</th></tr>")
    return rows.groupBy(*keys).agg(F.concat(F.lit("<table>"), head, body, F.lit("</table>")).alias("table"))


def write_site(rows: DataFrame, colours: DataFrame, files: DataFrame, mask: str, root: str, suffix: str = ".html", overwrite: bool = False, make=None, **options) -> DataFrame:
    """Writes a page for each file and gives (file_path, status) for all of files (file_path, size): no-blame, empty and
    masked ones are skipped, done ones stay unless overwrite is set, others are written. make takes the place of pages,
    for another look. Rows that are clustered by file do not move."""
    rows, colours = (x.filter(F.col("file_path").rlike(mask)) for x in (rows, colours))  # masked files have no pages
    made = (make or pages)(rows, colours, **options)
    content = F.col("html")
    if make is None and "footer" not in options:
        made = made.join(table_html(contributors.file_report(rows), ["file_path"]), "file_path", "left")
        content = F.concat(F.regexp_replace("html", r"(</pre></html>)?\z", ""), F.lit("</pre>"), F.coalesce("table", F.lit("")), F.lit("</html>"))
    state = F.when(~F.col("file_path").rlike(mask), "masked").when(F.col("html").isNull(), "no-blame").when(F.col("size") == 0, "empty")
    each = files.select("file_path", "size").join(made.withColumn("html", content).select("file_path", "html"), "file_path", "left").withColumn("status", state)
    # pages are made once: skipped files go through the same tasks as the others
    return write_files(each.select("file_path", F.when(F.col("status").isNull(), F.col("html")).alias("content"), "status"), root, suffix, overwrite)


def site_summary(status: DataFrame) -> dict[str, int]:
    """How many pages were newly written, were there already, and were skipped."""
    counts = {r.status: r.n for r in status.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {"written": counts.get("written", 0), "done": counts.get("done", 0), "skipped": sum(v for k, v in counts.items() if k not in ("written", "done"))}
