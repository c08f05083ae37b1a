"""Line dedup by site-relative frequency.

A line that stands on more than a given share of a host's pages is boilerplate there and goes
from all of them; a line on one page alone isn't. A row is a page; a line counts once a page. DataFrame functions only: lines
are counted by hashes of 128 bits, combined before the shuffle, so a line on a third of all
pages is no burden; and pages are joined by host with the host's boilerplate alone. A host has at
most (its mean number of lines a page) / ratio such lines, however many pages it has; Spark
broadcasts them while their size allows and splits a host's pages otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstats.llm import store

#: Share of a host's pages that a line may stand on. A line on one page alone is never boilerplate,
#: however few pages its host has.
RATIO, LEAST_PAGES = 0.1, 2
_SOLID = "[^ \\t\\n\\x0B\\f\\r]"


def _mark(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, host_column: str, text_column: str, ratio: float, least_pages: int) -> DataFrame:
    """host and marks (the hashes of its boilerplate lines); hosts without any are left out."""
    pages = docs.where(F.col(host_column).isNotNull()).select(F.col(host_column).alias("host"), F.col(text_column).cast("string").alias("text"))
    solid = F.filter(_lines(F.col("text")), lambda x: x.rlike(_SOLID))
    marks = pages.select("host", F.explode(F.array_distinct(F.transform(solid, _mark))).alias("mark"))
    counts = marks.groupBy("host", "mark.h1", "mark.h2").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    common = counts.join(totals, "host").where(F.col("n") > ratio * F.col("pages"))
    return common.groupBy("host").agg(F.collect_list(F.struct("h1", "h2")).alias("marks"))


def cleaned(docs: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES, host_column: str = "source", text_column: str = "text", length_column: str | None = "n_chars", count_columns: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` without the boilerplate lines; a column of the text's length follows the text.

    count_columns: names of two more columns, the lines with words and those dropped. Defined
    cases: blank lines are never dropped nor counted; a text of boilerplate alone becomes empty;
    a null text stays null and has no lines, but its row is a page; pages without a host are
    left as they are; repeated rows are pages of their own; an empty table gives none.
    """
    host, marks = store.free(docs, "host", "marks")
    common = store.keep(boilerplate(docs, host_column, text_column, ratio, least_pages), "line-boilerplate").toDF(host, marks)
    joined = docs.join(common, F.col(f"`{host_column}`") == F.col(f"`{host}`"), "left")
    text = F.col(f"`{text_column}`").cast("string")
    drops = lambda x: x.rlike(_SOLID) & F.array_contains(F.col(f"`{marks}`"), _mark(x))
    some = F.col(f"`{marks}`").isNotNull()
    new = F.when(some, F.array_join(F.filter(_lines(text), lambda x: ~drops(x)), "\n")).otherwise(text)
    columns = []
    for name in docs.columns:
        if name == text_column:
            columns.append(new.alias(name))
        elif name == length_column:
            columns.append(F.when(some, F.length(new)).otherwise(F.col(f"`{name}`")).cast("long").alias(name))
        else:
            columns.append(F.col(f"`{name}`"))
    if count_columns:
        solid = F.filter(_lines(text), lambda x: x.rlike(_SOLID))
        columns.append(F.coalesce(F.size(solid).cast("long"), F.lit(0).cast("long")).alias(count_columns[0]))
        columns.append(F.when(some & text.isNotNull(), F.size(F.filter(_lines(text), drops))).otherwise(0).cast("long").alias(count_columns[1]))
    return joined.select(*columns)


def oracle(ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> str:
    """The query over ``documents`` in DuckDB's SQL."""
    solid = "regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')"
    return f"""
with pages as (select doc_id, source, text, string_split(text, chr(10)) as lines from documents),
marks as (select source, unnest(list_distinct(list_filter(lines, lambda x: {solid}))) as line from pages where source is not null),
counts as (select source, line, count(*) as n from marks group by source, line having count(*) >= {least_pages}),
totals as (select source, count(*) as pages from pages group by source),
common as (select source, list(line) as drops from counts join totals using (source) where n > {ratio} * pages group by source)
select doc_id, coalesce(len(list_filter(lines, lambda x: {solid})), 0)::bigint as n_lines,
  case when text is null or drops is null then 0 else len(list_filter(lines, lambda x: {solid} and list_contains(drops, x))) end::bigint as n_dropped,
  sha256(case when drops is null then text else array_to_string(list_filter(lines, lambda x: not ({solid} and list_contains(drops, x))), chr(10)) end) as text_sha256
from pages left join common using (source)"""
