"""Line dedup by a log-template tree, in DataFrame operations only.

The tree has a fixed depth: a line goes down by its number of tokens and then by its
leading tokens, tokens with a digit counting as a variable field. In a leaf, a token
that enough documents share at one position is constant there and any other is a
variable field; the constants with the variables left open are the line's template. A
template met in enough documents, with enough constants after the leading tokens (those
are constant by the leaf), is boilerplate: its first line, by `doc_id` and place, stays
and every other one is dropped. A document counts once, however many of its lines share
a token or a template.

A line of few tokens goes down by all of them, so only equal lines meet; with a digit
or without a letter it says too little and stays.

Hot lines are harmless: lines are counted per leaf and document with partial
aggregation, leaves go on with one row per distinct line, and tables to join with are
broadcast while their counted rows are few; beyond that a plain sort-merge join is left,
which adaptive execution splits.

Defined results: null and empty texts have no lines to drop and stay as they are, as do
blank lines; equal rows are one document and are treated alike, and the one line kept is
then kept in each of them; rows without `doc_id` are told apart by their text and sort
first; columns beside `doc_id` and `text` are carried along, whatever their names; an
empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm._shared import staged

DEPTH = 3
VARIABLE = "<*>"


class Limits(NamedTuple):
    #: Documents in which a template must occur, and in which a token must recur to be constant.
    min_docs: int = 3
    #: Lines of fewer tokens must be equal as a whole.
    short: int = 5
    #: Share of the tokens after the leading ones that must be constant.
    min_constant: float = 0.6


#: Rows and bytes that are broadcast at most; more are joined by a shuffle.
BROADCAST, BROADCAST_BYTES = 500_000, 32 << 20


def _small(rows: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast when it is small enough as measured."""
    width = F.lit(0)
    for name, kind in rows.dtypes:
        size = F.octet_length(name) if kind == "string" else 8 * F.size(name) if kind.startswith("array") else F.lit(8)
        width = width + F.coalesce(size, F.lit(0)) + 8
    measured = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return F.broadcast(rows) if measured["n"] <= BROADCAST and measured["bytes"] <= BROADCAST_BYTES else rows


def _tidy(line: Column) -> Column:
    """Tokens with one blank between them; most lines are so already."""
    odd = line.contains("\t") | line.contains("\r") | line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    return F.when(odd, F.trim(F.regexp_replace(line, "[ \t\r]+", " "))).otherwise(line)


def _count(text: Column, letter: str) -> Column:
    """How often an ASCII letter occurs."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(letter), F.lit("")))


def _masked(text: Column) -> Column:
    """Tokens with a digit as variable fields."""
    return F.when(text.rlike("[0-9]"), F.regexp_replace(text, "[^ ]*[0-9][^ ]*", VARIABLE)).otherwise(text)


def _places(docs: DataFrame, limits: Limits, *more: str) -> DataFrame:
    """(id, key, pos, leaf) of every line that may recur; `key` tells rows of one `doc_id` apart by their text.

    Tokens are counted by their blanks and only the leading ones are cut out, so lines that
    end here are never taken apart.
    """
    lines = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64("text").alias("key"),
        F.posexplode(F.split("text", "\n")).alias("pos", "raw"),
    ).where(F.octet_length("raw") > 0)
    counted = lines.select("id", "key", "pos", _tidy(F.col("raw")).alias("line")).select(
        "id", "key", "pos", "line", (_count(F.col("line"), " ") + 1).alias("n")
    )
    short = F.col("n") < limits.short
    leading = F.when(short, F.col("line")).otherwise(_masked(F.substring_index("line", " ", DEPTH)))
    says = ~short | (F.col("line").rlike("\\p{L}") & ~F.col("line").rlike("[0-9]"))
    return counted.where(says).select("id", "key", "pos", F.xxhash64("n", leading).alias("leaf"), *more)


def _documents() -> Column:
    """How many documents: equal rows are one, rows without doc_id differ by their text."""
    return F.count_distinct(F.xxhash64("id", "key"))


def _same(docs: DataFrame, table: DataFrame) -> Column:
    """Whether a row of a table (`__id`, `__text_key`) belongs to a document with its `__key`."""
    return docs["doc_id"].cast("long").eqNullSafe(table["__id"]) & (docs["__key"] == table["__text_key"])


def _in_documents(parts: DataFrame, members: DataFrame, names: list[str], limits: Limits) -> DataFrame:
    """The `names` in enough documents. `parts`: (leaf, line_hash, n_docs) and `names` of every distinct line."""
    summed = parts.groupBy(*names).agg(F.sum("n_docs").alias("n"), F.max("n_docs").alias("most")).where(F.col("n") >= limits.min_docs)
    # One line in enough documents settles it; only where it takes several are their documents compared.
    summed = staged(summed.select(*names, (F.col("most") >= limits.min_docs).alias("sure")), "line-support")
    unsure = parts.join(summed.where(~F.col("sure")), names).select("line_hash", *names)
    proven = (
        unsure.join(members.select("leaf", "line_hash", "id", "key"), ["leaf", "line_hash"])
        .groupBy(*names)
        .agg(_documents().alias("n"))
        .where(F.col("n") >= limits.min_docs)
    )
    return staged(summed.where("sure").select(*names).union(proven.select(*names)), "line-support")


def recurring_lines(docs: DataFrame, limits: Limits = Limits(), with_text: bool = True) -> DataFrame:
    """(id, key, pos, template) of every line whose template is boilerplate, and the `template_text` if asked."""
    places = staged(_places(docs, limits), "line-places")
    leaves = staged(
        places.groupBy("leaf").agg(_documents().alias("n")).where(F.col("n") >= limits.min_docs).select("leaf"),
        "line-leaves",
    )
    # Only documents with a line in a recurring leaf are cut up again.
    asked = staged(places.join(_small(leaves), "leaf").select(F.col("id").alias("__id"), F.col("key").alias("__text_key")).distinct(), "line-asked")
    here = docs.select("doc_id", "text", F.xxhash64("text").alias("__key"))
    lines = _places(here.join(_small(asked), _same(here, asked), "left_semi"), limits, "line")
    members = lines.join(_small(leaves), "leaf").withColumn("line", _masked(F.col("line")))
    members = staged(members.withColumn("line_hash", F.xxhash64("line")), "line-members")

    distinct = (
        members.groupBy("leaf", "line_hash")
        .agg(_documents().alias("n_docs"), F.min("line").alias("line"))
        .select("leaf", "line_hash", "n_docs", F.split("line", " ").alias("tokens"))
    )
    fields = distinct.select("leaf", "line_hash", "n_docs", F.posexplode("tokens").alias("at", "token"))
    constant = _in_documents(fields.where(F.col("token") != VARIABLE), members, ["leaf", "at", "token"], limits).withColumn(
        "is_constant", F.lit(True)
    )
    size, after = F.size("words"), F.col("n_constant") - F.col("n_leading")
    steady = F.when(size < limits.short, F.col("n_constant") == size).otherwise(after >= (size - DEPTH) * limits.min_constant)
    template = F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda field: field["word"])
    described = (
        fields.join(constant, ["leaf", "at", "token"], "left")
        .withColumn("word", F.when(F.col("is_constant"), F.col("token")).otherwise(F.lit(VARIABLE)))
        .groupBy("leaf", "line_hash")
        .agg(
            template.alias("words"),
            F.first("n_docs").alias("n_docs"),
            F.count("is_constant").alias("n_constant"),
            F.count(F.when(F.col("at") < DEPTH, F.col("is_constant"))).alias("n_leading"),
        )
        .where(steady)
        .select("leaf", "line_hash", "n_docs", F.concat_ws(" ", "words").alias("template_text"))
    )
    described = staged(described, "line-templates")
    shared = _in_documents(described, members, ["leaf", "template_text"], limits)
    boilerplate = described.join(shared, ["leaf", "template_text"]).select(
        "leaf", "line_hash", F.xxhash64("leaf", "template_text").alias("template"), *(["template_text"] if with_text else [])
    )
    boilerplate = _small(staged(boilerplate, "line-boilerplate"))
    return members.select("leaf", "line_hash", "id", "key", "pos").join(boilerplate, ["leaf", "line_hash"]).drop(
        "leaf", "line_hash"
    )


def _kept_text(text: Column, dropped: Column) -> Column:
    """The lines between dropped places, joined again; linear in the number of lines."""
    lines = F.split(text, "\n")
    bounds = F.concat(F.array(F.lit(-1)), dropped, F.array(F.size(lines)))
    runs = F.transform(
        F.sequence(F.lit(1), F.size(bounds) - 1),
        lambda at: F.slice(
            lines, F.element_at(bounds, at) + 2, F.element_at(bounds, at + 1) - F.element_at(bounds, at) - 1
        ),
    )
    return F.concat_ws("\n", F.flatten(runs))


def dropped_lines(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(id, key, dropped): places of the lines to drop, ascending."""
    found = staged(recurring_lines(docs, limits, with_text=False), "line-occurrences")
    place = F.struct("id", "key", "pos")
    first = staged(found.groupBy("template").agg(F.min(place).alias("first")), "line-first")
    later = found.join(_small(first), "template").where(~F.col("first").eqNullSafe(place))
    return later.groupBy("id", "key").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def dedup_lines(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """`docs` with the kept lines as `text`, plus `__n_lines` and `__n_dropped`."""
    dropped = dropped_lines(docs, limits)
    dropped = staged(dropped.toDF("__id", "__text_key", "__dropped"), "line-dropped")
    here = docs.withColumn("__key", F.xxhash64("text"))
    joined = here.join(_small(dropped), _same(here, dropped), "left")
    lines = F.when(F.col("text").isNull(), 0).otherwise(_count(F.col("text"), "\n") + 1)
    counted = joined.withColumns({"__n_lines": lines, "__n_dropped": F.coalesce(F.size("__dropped"), F.lit(0))})
    text = F.when(F.col("__n_dropped") > 0, _kept_text(F.col("text"), F.col("__dropped"))).otherwise(F.col("text"))
    return counted.withColumn("text", text).select(*docs.columns, "__n_lines", "__n_dropped")


def line_report(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256 of the text that is left."""
    result = dedup_lines(docs.select("doc_id", "text"), limits)
    return result.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("__n_lines").cast("long").alias("n_lines"),
        F.col("__n_dropped").cast("long").alias("n_dropped"),
        F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"),
    )


def without_boilerplate(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents with boilerplate lines dropped; one of which no word is left goes as a whole."""
    result = dedup_lines(docs, limits)
    emptied = (F.col("__n_dropped") > 0) & ~F.col("text").rlike("[^ \t\r\n]")
    return result.where(~emptied).select(*docs.columns)


def line_dedup_sql(limits: Limits = Limits()) -> str:
    """The same report as DuckDB SQL over `documents`."""
    leading = f"array_to_string(CASE WHEN len(tokens) < {limits.short} THEN tokens ELSE tokens[1:{DEPTH}] END, ' ')"
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS r, dense_rank() OVER (ORDER BY doc_id NULLS FIRST, text NULLS FIRST) AS doc,
                        CAST(doc_id AS BIGINT) AS id, coalesce(text, '') AS text, text IS NULL AS is_null FROM documents),
        lines AS (SELECT r, doc, id, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
                         unnest(string_split(text, chr(10))) AS line FROM docs),
        tidy AS (SELECT r, doc, id, pos, trim(regexp_replace(line, '[ \t\r]+', ' ', 'g'), ' ') AS line FROM lines),
        masked AS (SELECT r, doc, id, pos, line, string_split(regexp_replace(line, '[^ ]*[0-9][^ ]*', '{VARIABLE}', 'g'), ' ') AS tokens
                   FROM tidy WHERE line <> ''),
        tree AS (SELECT r, doc, id, pos, tokens, concat_ws(chr(1), len(tokens), {leading}) AS leaf FROM masked
                 WHERE len(tokens) >= {limits.short} OR regexp_matches(line, '\\p{{L}}') AND NOT regexp_matches(line, '[0-9]')),
        leaves AS (SELECT leaf FROM tree GROUP BY leaf HAVING count(DISTINCT doc) >= {limits.min_docs}),
        members AS (SELECT tree.* FROM tree JOIN leaves USING (leaf)),
        fields AS (SELECT leaf, tokens, doc, generate_subscripts(tokens, 1) AS spot, unnest(tokens) AS token FROM members),
        constant AS (SELECT leaf, spot, token FROM fields WHERE token <> '{VARIABLE}'
                     GROUP BY leaf, spot, token HAVING count(DISTINCT doc) >= {limits.min_docs}),
        distinct_fields AS (SELECT DISTINCT leaf, tokens, spot, token FROM fields),
        described AS (SELECT f.leaf, f.tokens, string_agg(coalesce(c.token, '{VARIABLE}'), ' ' ORDER BY f.spot) AS template
                      FROM distinct_fields f LEFT JOIN constant c USING (leaf, spot, token) GROUP BY f.leaf, f.tokens
                      HAVING CASE WHEN len(f.tokens) < {limits.short} THEN count(c.token) = len(f.tokens)
                                  ELSE count(c.token) FILTER (WHERE f.spot > {DEPTH}) >= (len(f.tokens) - {DEPTH}) * {limits.min_constant} END),
        meant AS (SELECT m.r, m.doc, m.id, m.pos, m.leaf, d.template FROM members m JOIN described d USING (leaf, tokens)),
        shared AS (SELECT leaf, template FROM meant GROUP BY leaf, template HAVING count(DISTINCT doc) >= {limits.min_docs}),
        found AS (SELECT * FROM meant JOIN shared USING (leaf, template)),
        later AS (SELECT r, pos FROM (SELECT r, pos, rank() OVER (PARTITION BY leaf, template ORDER BY id NULLS FIRST, doc, pos) AS n FROM found)
                  WHERE n > 1),
        kept AS (SELECT l.r, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE x.pos IS NULL) AS text,
                        count(*) AS n_lines, count(x.pos) AS n_dropped
                 FROM lines l LEFT JOIN later x ON x.r = l.r AND x.pos = l.pos GROUP BY l.r)
        SELECT d.id AS doc_id, CASE WHEN d.is_null THEN 0 ELSE k.n_lines END AS n_lines, k.n_dropped, sha256(coalesce(k.text, '')) AS kept_sha256
        FROM docs d JOIN kept k USING (r)
    """
