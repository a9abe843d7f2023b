"""Recognised documents: cleaning to file, page and block contents, statistics, and the search texts of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import jsonx as js
from scriptorium.functions import text as tx

# Fixed values.
KEPT_TYPES = ("text", "title", "subtitle", "table")
SOURCES = ("printed", "handwritten", "mixed")
CLEAN = "array<struct<file:string,page:int,blocks:array<struct<type:string,content:string>>>>"


def _list(v: Column, path: str) -> Column:
    return F.when(js.field_kind(v, path).startswith("ARRAY"), js.get(v, path, js.VARIANTS))


def rows_text(rows: Column) -> Column:
    """Rows of cells as lines; a row that is no list is one cell."""

    def line(row: Column) -> Column:
        cells = F.when(F.schema_of_variant(row).startswith("ARRAY"), js.get(row, "$", js.VARIANTS)).otherwise(F.array(row))
        return F.array_join(F.transform(cells, lambda c: tx.strip(js.plain(c))), " | ")

    return tx.strip(F.array_join(F.transform(rows, line), "\n"))


def block_content(block: Column) -> Column:
    """The content of a block: a list line by line, else as text; the rows of a table where that is empty."""
    listed = F.array_join(F.transform(_list(block, "$.content"), js.plain), "\n")
    content = tx.strip(F.coalesce(listed, js.truthy_text(js.get(block, "$.content", "variant")), F.lit("")))
    return tx.let(content, lambda c: F.when(c == "", F.coalesce(rows_text(_list(block, "$.rows")), F.lit(""))).otherwise(c))


def clean(document: Column) -> Column:
    """A document's pages as ``CLEAN``: pages and blocks that are no objects go, and empty blocks; empty pages stay."""
    root = tx.basename(js.truthy_text(js.get(document, "$.source_file", "variant")))

    def block(b: Column) -> Column:
        kind = F.lower(tx.strip(F.coalesce(js.plain(js.get(b, "$.type", "variant")), F.lit("text"))))
        return F.struct(F.when(kind.isin(*KEPT_TYPES), kind).otherwise("text").alias("type"), block_content(b).alias("content"))

    pages = F.coalesce(_list(document, "$.pages"), F.array().cast(js.VARIANTS))
    # A page without a number has its place among the pages, so the place is settled before others go.
    at = F.transform(pages, lambda p, i: F.struct(p.alias("p"), (i + 1).alias("i")))

    def page(x: Column) -> Column:
        p = x["p"]
        number = lambda path, fallback: tx.positive_int(js.get(p, path, "string"), fallback)
        file = tx.basename(js.truthy_text(js.get(p, "$.source_file", "variant")))
        blocks = F.transform(F.filter(F.coalesce(_list(p, "$.blocks"), F.array().cast(js.VARIANTS)), js.is_object), block)
        return F.struct(
            F.when(file == "", root).otherwise(file).alias("file"),
            number("$.source_page", number("$.page", x["i"])).alias("page"),
            F.filter(blocks, lambda b: b["content"] != "").alias("blocks"),
        )

    return F.transform(F.filter(at, lambda x: js.is_object(x["p"])), page)


def explode_clean(df: DataFrame, keys: list[str], pages: str = "pages") -> DataFrame:
    """(keys, p, file, page, k, type, content) of cleaned documents; an empty page has one row with a null k."""
    page = df.select(*keys, F.posexplode(pages).alias("p", "page"))
    return page.select(*keys, "p", "page.file", F.col("page.page").alias("page"), F.posexplode_outer("page.blocks").alias("k", "b")).select(*keys, "p", "file", "page", "k", "b.type", "b.content")


def statistics(pages: Column) -> Column:
    """Struct (pages, blocks, tables, content_chars) of a cleaned document."""
    blocks = F.flatten(pages["blocks"])
    return tx.let(
        blocks,
        lambda b: F.struct(
            F.size(pages).cast("bigint").alias("pages"), F.size(b).cast("bigint").alias("blocks"), F.size(F.filter(b, lambda x: x["type"] == "table")).cast("bigint").alias("tables"),
            F.aggregate(b, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x["content"])).alias("content_chars"),
        ),
    )


def search_texts(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, hay1, hay2): the contents of a page in order as a normalised literal, also without cell marks.

    df: (keys, ord, content); rows of equal keys come together wherever they stand."""
    whole = df.where("content <> ''").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("ord", "content"))).alias("c"))
    text = F.array_join("c.content", "\n")
    return whole.select(*keys, tx.normalized_literal(text).alias("hay1"), tx.normalized_literal(F.replace(text, F.lit(" | "), F.lit(" "))).alias("hay2"))


def region(v: Column) -> Column:
    """Struct (type, source, languages, content, rows) of a recognised region's data; null where its content is empty."""
    kind = F.lower(tx.strip(F.coalesce(js.plain(js.get(v, "$.type", "variant")), F.lit("text"))))
    source = F.lower(tx.strip(F.coalesce(js.plain(js.get(v, "$.source", "variant")), F.lit("mixed"))))
    listed = F.transform(_list(v, "$.languages"), lambda x: tx.strip(js.plain(x)))
    languages = F.filter(F.coalesce(listed, F.when(js.field_kind(v, "$.languages") == "STRING", F.array(tx.strip(js.get(v, "$.languages", "string"))))), lambda x: x != "")
    languages = F.when(F.size(languages) > 0, languages).otherwise(F.array(F.lit("ru")))
    cells = lambda r: F.when(F.schema_of_variant(r).startswith("ARRAY"), js.get(r, "$", js.VARIANTS)).otherwise(F.array(r))
    rows = F.transform(F.coalesce(_list(v, "$.rows"), F.array().cast(js.VARIANTS)), lambda r: F.transform(cells(r), lambda c: tx.strip(js.plain(c))))
    given = js.get(v, "$.content", "variant")
    content = tx.strip(F.coalesce(F.array_join(F.transform(_list(v, "$.content"), js.plain), "\n"), F.when(js.field_kind(v, "$.content").isNull(), F.lit("")).otherwise(js.plain(given))))
    table = kind == "table"
    return tx.let(
        F.struct(content.alias("c"), rows.alias("r")),
        lambda x: tx.let(
            F.when(x["c"] != "", x["c"]).otherwise(F.array_join(F.transform(x["r"], lambda r: F.array_join(r, " | ")), "\n")),
            lambda c: F.when(
                c != "",
                F.struct(
                    F.when(table, "table").otherwise("text").alias("type"), F.when(source.isin(*SOURCES), source).otherwise("mixed").alias("source"), languages.alias("languages"),
                    c.alias("content"), F.when(table & (F.size(x["r"]) > 0), x["r"]).alias("rows"),
                ),
            ),
        ),
    )
