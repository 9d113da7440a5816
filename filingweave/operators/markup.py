"""The roster table of a filing document.

Python only turns markup into nodes (one Arrow column in, one out). Matching, scoring, choosing and row
assembly are column expressions on that nested value, so a document is never shuffled and its table is
found inside the task that read it.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingweave import fixed_values as fv
from filingweave.functions import rows as R
from filingweave.functions.headers import header_fields, is_header
from filingweave.functions.text import contains_all, contains_any, squash, token_count, trim_u
from filingweave.operators.computed import computed
from filingweave.operators.nodes import NODE_TYPE, NODE_TYPE_ARROW, any_of, read_nodes

_CHARS_AT_ONCE = 200_000

Keywords = Sequence[tuple[str, int]]


def markup_nodes(
    text: Column,
    words: Sequence[str] = tuple(w for w, _ in fv.KEYWORD_SCORES),
    mark: str = fv.CONCURRENT_WORD,
    behind_hits: bool = False,
    squashed: bool = False,
) -> Column:
    """struct<texts, tables>: the text nodes that hold one of the words, and every table.

    No words: all text nodes. ``behind_hits``: tables before the first such node, which no keyword can win
    for, stay in the worker. ``squashed``: texts are looked at, and given, without blanks and quotes. Declared nondeterministic so that Spark never parses a document twice by
    copying this expression into a pushed-down filter.
    """

    wanted = any_of(words)

    @F.arrow_udf(NODE_TYPE)
    def parse(texts: pa.Array) -> pa.Array:
        # Python objects are many times larger than Arrow's: only some documents at a time are such
        done, some, size = [], [], 0
        collecting = gc.isenabled()
        gc.disable()  # trees go without the collector, which would look through all of them again and again
        try:
            for text in texts:
                markup = text.as_py()
                some.append(read_nodes(markup, wanted, mark, behind_hits, squashed))
                size += len(markup or "")
                if size > _CHARS_AT_ONCE:
                    done.append(pa.array(some, type=NODE_TYPE_ARROW))
                    some, size = [], 0
            return pa.concat_arrays([*done, pa.array(some, type=NODE_TYPE_ARROW)])
        finally:
            if collecting:
                gc.enable()

    return parse.asNondeterministic()(text)


def may_hold(text: Column, words: Sequence[str], squashed: bool = False) -> Column:
    """False only if no text node can hold any of the words, decided on the raw markup.

    A word is there as written, or some of it is an entity. The everyday entities cannot spell a word
    without blanks, quotes and angle brackets of their kind, so they do not count; in ``squashed`` text
    blanks and quotes vanish, so there those two do.
    """
    harmless = not any(ch in w for w in words for ch in "\u00a0&<>\"")
    everyday = "amp|lt|gt" if squashed else "nbsp|amp|lt|gt|quot"
    entity = F.regexp_like(text, F.lit(f"&(?!(?:{everyday});)")) if harmless else F.contains(text, F.lit("&"))
    return contains_any(text, words) | entity


def score_levels(keywords: Keywords, penalty: int = fv.CONCURRENT_PENALTY) -> list[tuple[int, int, bool]]:
    """(score, keyword order, concurrent) for each way a keyword can be hit."""
    return [
        (score - penalty * concurrent, i, bool(concurrent))
        for i, (_, score) in enumerate(keywords)
        for concurrent in (0, 1)
    ]


def best_hit(firsts: Sequence[Column], levels: Sequence[tuple[int, int]], pos: Column) -> Column:
    """The strongest level whose first hit lies before ``pos``: struct<score, rank, hit> or null.

    Only the first hit of a level matters: a later one scores the same and loses every tie. So any number
    of hits is reduced to one position for each level before tables are looked at.
    """
    options = [
        F.when(
            first < pos,
            F.struct(
                F.lit(score).alias("score"), F.lit(-rank).alias("rank"), (-first).alias("hit")
            ),
        )
        for first, (score, rank) in zip(firsts, levels)
    ]
    return F.greatest(*options) if len(options) > 1 else options[0]


def table_bonus(norm: Column) -> Column:
    """Score a squashed table text earns by itself; null when it is no candidate."""
    enough = token_count(norm, fv.HEADER_TOKENS) >= fv.MIN_TOKENS
    header = contains_all(norm, fv.BONUS_WORDS)
    bonus = enough.cast("int") * fv.TOKEN_BONUS + header.cast("int") * fv.HEADER_BONUS
    return F.when(enough | header, bonus)


def is_concurrent(node: Column) -> Column:
    """A text node about posts held elsewhere, by its own text or its surroundings."""
    return F.contains(node["text"], F.lit(fv.CONCURRENT_WORD)) | node["marked"]


def _first_hit(hits: Column, word: str, concurrent: bool) -> Column:
    of_level = F.filter(hits, lambda h: F.contains(h["text"], F.lit(word)) & (h["c"] == F.lit(concurrent)))
    return F.array_min(F.transform(of_level, lambda h: h["pos"]))


def best_table(nodes: Column, keywords: Keywords = fv.KEYWORD_SCORES) -> Column:
    """The winning table of a document's nodes: struct<score, rank, hit, pos>, null without one.

    Ties go to the earlier keyword, then the earlier hit, then the earlier table. The last three fields
    are negated positions, so that one maximum decides everything.
    """
    levels = score_levels(keywords)
    hits = F.transform(
        nodes["texts"],
        lambda t: F.struct(t["pos"].alias("pos"), t["text"].alias("text"), is_concurrent(t).alias("c")),
    )
    firsts = _once(
        hits,
        lambda h: F.struct(
            *[
                _first_hit(h, keywords[rank][0], concurrent).alias(f"l{i}")
                for i, (_, rank, concurrent) in enumerate(levels)
            ]
        ),
    )
    norms = F.transform(
        nodes["tables"], lambda t: F.struct(t["pos"].alias("pos"), squash(t["text"]).alias("norm"))
    )
    tables = F.transform(
        norms, lambda t: F.struct(t["pos"].alias("pos"), table_bonus(t["norm"]).alias("bonus"))
    )
    candidates = F.filter(tables, lambda t: t["bonus"].isNotNull())
    scored = _once(firsts, lambda f: _score_all(f, candidates, levels))
    return F.array_max(F.filter(scored, lambda s: s["score"] >= 0))


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with value computed a single time however often it is used."""
    return F.get(F.transform(F.array(value), lambda v: then(v)), F.lit(0))


def _score_all(found: Column, candidates: Column, levels) -> Column:
    firsts = [found[f"l{i}"] for i in range(len(levels))]
    ranked = [(score, rank) for score, rank, _ in levels]

    def score(t: Column) -> Column:
        hit = best_hit(firsts, ranked, t["pos"])
        return F.struct(
            (hit["score"] + t["bonus"]).alias("score"),
            hit["rank"].alias("rank"),
            hit["hit"].alias("hit"),
            (-t["pos"]).alias("pos"),
        )

    return F.transform(candidates, score)


def body_rows(table: Column) -> Column:
    """Rows of the first body, even if it has none; without a body, all rows outside the head."""
    return F.when(
        table["body"],
        F.filter(table["rows"], lambda r: r["section"] == "body"),
    ).otherwise(F.filter(table["rows"], lambda r: r["section"] != "head"))


def _of_kind(cells: Column, kind: str) -> Column:
    return F.transform(F.filter(cells, lambda c: c["kind"] == kind), lambda c: c["text"])


def row_cells(row: Column, keep_empty_cells: bool = False) -> Column:
    """td texts; null for a header row (th only); otherwise the texts of the row's own child tags."""
    cells = row["cells"]
    other = F.transform(cells, lambda c: c["text"])
    if not keep_empty_cells:
        other = F.filter(other, lambda c: c != "")
    return (
        F.when(F.exists(cells, lambda c: c["kind"] == "td"), _of_kind(cells, "td"))
        .when(F.exists(cells, lambda c: c["kind"] == "th"), F.lit(None))
        .otherwise(other)
    )


def table_data(table: Column, keep_empty_cells: bool = False) -> Column:
    """array<array<string>>: the data rows, blank ones dropped."""
    read = F.transform(body_rows(table), lambda r: row_cells(r, keep_empty_cells))
    return F.filter(read, lambda cells: F.exists(cells, lambda c: trim_u(c) != ""))


def table_header(table: Column) -> Column:
    """The widest header row (th only, or inside the head); null when the table has none."""

    def heads(r: Column) -> Column:
        th_only = F.exists(r["cells"], lambda c: c["kind"] == "th") & ~F.exists(
            r["cells"], lambda c: c["kind"] == "td"
        )
        return th_only | (r["section"] == "head")

    texts = F.transform(
        F.filter(table["rows"], heads), lambda r: F.transform(r["cells"], lambda c: c["text"])
    )
    ranked = F.transform(texts, lambda t, i: F.struct(F.size(t), (-i).alias("at"), t.alias("texts")))
    return F.array_max(ranked)["texts"]


def table_at(tables: Column, best: Column) -> Column:
    """The table a best_table result points to."""
    # bound once: written into the filter, Spark would score the whole document again for every table
    return _once(
        best, lambda b: F.get(F.filter(tables, lambda t: t["pos"] == -b["pos"]), F.lit(0))
    )


def extract_rows(
    documents: DataFrame,
    text: str = "xml_text",
    keywords: Keywords = fv.KEYWORD_SCORES,
    keep_empty_cells: bool = False,
    squash_headings: bool = False,
    first_of: Sequence[str] | None = None,
    index: str = "xml_index",
    error: str | None = None,
) -> DataFrame:
    """Documents -> the rows of each one's roster table: row_index, cells, header, fields_json (the record
    field of every column), other columns kept.

    ``squash_headings`` matches the keywords on text without whitespace and quotes, which also finds
    headings written with unusual blanks. ``first_of`` names the columns of a filing and keeps, of each,
    only the first document by ``index`` that has a table. Rows with an ``error`` pass through with no cells.
    """
    failed = F.col(error).isNotNull() if error else F.lit(False)
    kept = [c for c in documents.columns if c != text]
    raw = F.col(text)
    if squash_headings:
        keywords = [("".join(w.split()), s) for w, s in keywords]
        raw = squash(raw)
    words = [w for w, _ in keywords]
    # most documents of a filing have no such heading, or no table, and never reach Python
    worth_reading = may_hold(raw, words, squash_headings) & F.regexp_like(F.col(text), F.lit("(?i)<table"))
    nodes = documents.where(worth_reading | failed).select(
        *kept, markup_nodes(F.col(text), words, behind_hits=True, squashed=squash_headings).alias("_nodes")
    )
    chosen = computed(nodes, _best=best_table(F.col("_nodes"), keywords))
    tables = computed(chosen, _table=table_at(F.col("_nodes.tables"), F.col("_best")))
    read = computed(
        tables,
        _th=table_header(F.col("_table")),
        _data=table_data(F.col("_table"), keep_empty_cells),
    )
    # a table without a proper header row may name its columns in its first data row
    named = F.when(is_header(F.col("_th")), F.col("_th")).otherwise(F.get("_data", F.lit(0)))
    found = computed(read, header=R.clean_cells(named)).select(*kept, "header", "_data")
    if first_of:
        # failures of a filing stay apart from its documents, and from each other
        found = found.where((F.size("_data") > 0) | failed).withColumn("_failed", F.when(failed, F.struct(index)))
        found = found.groupBy(*first_of, "_failed").agg(
            F.min_by(F.struct(*[c for c in found.columns if c not in [*first_of, "_failed"]]), F.coalesce(index, F.lit(-1))).alias("_first")
        )
        found = found.select(*first_of, "_first.*")
    return (
        computed(
            found,
            _width=F.array_max(F.transform("_data", F.size)),
            # what each column means, settled once a table rather than once a row
            fields_json=F.to_json(header_fields(F.col("header"))),
        )
        .select(
            *kept, "header", "fields_json", "_width",
            F.posexplode_outer("_data").alias("row_index", "_cells"),
        )
        .where(F.col("row_index").isNotNull() | failed)
        .withColumn("cells", R.clean_cells(R.pad_cells(F.col("_cells"), F.col("_width"))))
        .drop("_width", "_cells")
    )


def encode_rows(rows: DataFrame) -> DataFrame:
    cells = F.col("cells")
    return rows.withColumns(
        {
            "columns_json": R.columns_json(cells),
            "row_json": R.row_json(cells),
            "row_text": R.row_text(cells),
            "header_json": F.to_json("header"),
        }
    ).drop("cells", "header")
