"""Spelling variants: words one code point apart, found by walking tries level by level as joins.

The words are filed in two tries, one read forwards and one backwards. A level of both is a
table of edges (node, first character, label, child); a node with a single way on has no
level of its own, so long words that share a long beginning do not make a deep trie. A
state (word, node, rest, edits) is a word on its way: joined with the edges of its node it
goes on where the label agrees, and once in its walk one character of the word may be left
out or replaced by a larger one. Edits are taken in the later half of a word only, where
nodes have few children; the other half is the later half of the word read backwards. A
state that ends at the end of another word with one edit makes the two neighbours; the
pair counts for both.

Every level is written to the shared folder and read back. The edges of a level are sent to
all tasks while their measured size is small, and joined by shuffle with hot nodes split
beyond that.

Defined results: null and empty texts have no words. A row without `doc_id` has no hash, so
its runs stay whole. Repeated rows count each time. Of near words equally frequent the
smallest in code-point order is the form. Other columns are ignored; an empty table gives
no rows. Memory is one batch of texts and a bounded table of counts; a text of any length
is looked at in pieces that end between runs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm._shared import slices, staged
from tallyhouse.operators.skew import join_unique
from tallyhouse.sources.storage import Stored, TableStore

#: A run in lower-cased UTF-8: À to ÿ are C3 and one byte more, and no other character has a C3 in front.
_RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
_GAP = re.compile(rb"[^a-z\x80-\xff]")


class Words(NamedTuple):
    #: Runs whose hash is divisible by this lose a code point.
    damage: int = 97
    min_length: int = 5
    min_count: int = 3
    #: A form is at least this many times as frequent.
    dominance: int = 2


#: Distinct runs counted before a task hands them on, and bytes of them.
HELD, HELD_BYTES = 200_000, 16 << 20
#: Bytes of a text looked at in one go.
PIECE = 1 << 20
#: A level's edges are sent to all tasks up to this many of them and bytes of their labels: some 30 MB.
SENT_EDGES, SENT_BYTES = 300_000, 8 << 20
#: Characters after the first that a state looks ahead.
AHEAD = 3


def _pieces(data: bytes) -> Iterator[bytes]:
    """The text in pieces of about `PIECE` bytes; a run is never cut."""
    start = 0
    while len(data) - start > PIECE:
        gap = _GAP.search(data, start + PIECE)
        end = len(data) if gap is None else gap.start()
        yield data[start:end]
        start = end
    yield data[start:]


def damaged(run: bytes, h: int) -> bytes:
    """The run without the code point that its hash names."""
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def words_of(doc_id: int | None, text: str, rules: Words) -> Iterator[tuple[bytes, int]]:
    """The words of one text, each run with the number of times it occurs."""
    runs: Counter[bytes] = Counter()
    for piece in _pieces(text.encode("utf-8", "surrogatepass").lower()):  # of bytes, only A-Z are lower-cased
        runs.update(_RUN.findall(piece))
    start = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
    least, every = rules.min_length, rules.damage
    for run, n in runs.items():
        if len(run) < least:
            continue
        if start is not None and not (h := zlib.crc32(run, start)) % every:
            run = damaged(run, h)
        if len(run) - run.count(b"\xc3") >= least:
            yield run, n


def word_counts(docs: DataFrame, words: Words = Words()) -> DataFrame:
    """(word, n) of all words long and frequent enough; counted in the tasks before they are shuffled."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        held_bytes = 0

        def flush() -> pa.RecordBatch:
            found = [pa.array(held.keys(), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(found, ["word", "n"])

        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for word, n in words_of(doc_id, text or "", words):
                    before = held.get(word)
                    if before is None:
                        held_bytes += 2 * len(word)
                    held[word] = n + (before or 0)
                if len(held) > HELD or held_bytes > HELD_BYTES:
                    yield flush()
                    held_bytes = 0
        if held:
            yield flush()

    counted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= words.min_count)


def _character(text: Column, at: Column | int) -> Column:
    return F.substr(text, F.lit(at) if isinstance(at, int) else at, F.lit(1))


def _after(text: Column, count: Column) -> Column:
    return F.substr(text, count + 1)


def _common(left: Column, right: Column) -> Column:
    """Length of the common beginning of two texts."""
    least = F.least(F.length(left), F.length(right))
    # Single characters as arrays: positions of a string are found by walking it.
    a, b = (F.split(F.substr(text, F.lit(1), least), "") for text in (left, right))
    unlike = F.array_position(F.zip_with(a, b, lambda x, y: x != y), True)
    return F.when(least == 0, 0).when(unlike == 0, least).otherwise(unlike - 1).cast("int")


def _edges(exact: DataFrame) -> DataFrame:
    """(node, label, child, lengths, ahead) of the words still on their way at the nodes of one level.

    The common beginning of a group is that of its smallest and its largest member, and both
    are found in the map tasks. `lengths` has a bit for every length left at the node, and
    `ahead` one for what follows the first character.
    """
    rest = F.col("rest")
    ways = exact.where(F.length("rest") > 0).groupBy("node", _character(rest, 1).alias("way"))
    found = ways.agg(
        F.min("rest").alias("low"), F.max("rest").alias("high"),
        F.bit_or(_length_bit(F.length("rest"))).alias("lengths"), F.bit_or(_ahead_bit(rest, 2)).alias("ahead"),
    )
    label = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(
        F.substr("low", F.lit(1), _common(F.col("low"), F.col("high")))
    )
    return found.select("node", label.alias("label"), F.monotonically_increasing_id().alias("child"), "lengths", "ahead")


def _one_bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), number.cast("int"))


def _length_bit(length: Column) -> Column:
    """The bit for a length; all beyond 61 characters share one."""
    return _one_bit(F.least(length, F.lit(62)))


def _ahead_bit(text: Column, at: int) -> Column:
    """The bit for the up to `AHEAD` characters from `at`; different ones may share it."""
    return _one_bit(F.pmod(F.xxhash64(F.substr(text, F.lit(at), F.lit(AHEAD))), F.lit(63)))


def _has(bits: str, bit: Column) -> Column:
    return F.col(bits).bitwiseAND(bit) != 0


def _advance(states: DataFrame, edges: Stored, label_bytes: int) -> DataFrame:
    """States after one edge: straight on, with a character replaced by a larger one, or with one left out.

    The label of a word's own edge is a beginning of its rest, and all words below have it; so
    an edit is always of the first character at a node, and leads to another edge. Leaving out
    any of a run of equal characters gives the same word, and only the last of them differs
    from what follows. With its edit made, a state goes on only where a word as long, with
    the same characters ahead, may be below.
    """
    rest, first, way, size = F.col("rest"), F.col("first"), F.col("way"), F.col("size")
    # What a pair of state and edge is judged by is worked out once per state and once per edge.
    on_way = states.where(F.length("rest") > 0).withColumns(
        {
            "first": _character(rest, 1),
            "may_edit": (F.col("edits") == 0) & (F.col("length") - F.length("rest") >= F.col("first_edit")),
            "as_long": _length_bit(F.length("rest")),
            "as_ahead": _ahead_bit(rest, 2),
        }
    )
    label = F.col("label")
    ways = edges.df.withColumns({"way": _character(label, 1), "size": F.length("label")})
    if edges.rows <= SENT_EDGES and label_bytes <= SENT_BYTES:
        joined = on_way.join(F.broadcast(ways), "node")
    else:
        joined = join_unique(on_way, ways, "node", ["word", "rest"], "inner")
    fits = _has("lengths", F.col("as_long")) & _has("ahead", F.col("as_ahead"))
    straight = (first == way) & ((F.col("edits") == 0) | (fits & F.startswith(rest, label)))
    replaced = F.col("may_edit") & (first < way) & fits & (F.substr(rest, F.lit(2), size - 1) == _after(label, F.lit(1)))
    left_out = F.col("may_edit") & (first != way) & (_character(rest, 2) == way)
    left_out &= _has("lengths", _length_bit(F.length("rest") - 1)) & _has("ahead", _ahead_bit(rest, 3))
    left_out &= F.startswith(_after(rest, F.lit(1)), label)
    # One character more than the label has is used up where one is left out.
    used = F.array(F.when(straight | replaced, size), F.when(left_out, size + 1))
    edited = F.when(first == way, F.col("edits")).otherwise(1).alias("edits")
    moved = joined.where(straight | replaced | left_out).select(
        "word", "length", "first_edit", "rest", "child", edited, F.explode(used).alias("used")
    )
    return moved.where(F.col("used").isNotNull()).select(
        "word", "length", "first_edit", F.col("child").alias("node"), _after(rest, F.col("used")).alias("rest"), "edits"
    )


def _met(states: DataFrame) -> DataFrame:
    """Pairs (a, b) of a word with one edit and the word that ends at its node; nodes are told apart by level and number.

    A last character may also be left out at the very end.
    """
    ends = states.where("edits = 0 and length(rest) = 0").select("level", "node", F.col("word").alias("b"))
    arrived = states.where("(edits = 1 and length(rest) = 0) or (edits = 0 and length(rest) = 1 and length > first_edit)")
    return arrived.select("level", "node", F.col("word").alias("a")).join(ends, ["level", "node"]).select("a", "b")


def near_pairs(words: DataFrame, store: TableStore) -> DataFrame:
    """(a, b), both ways round, of all words (id, word) that differ by one inserted, left out or replaced code point."""
    length, half = F.length("word").cast("int"), F.call_function("div", F.length("word"), F.lit(2)).cast("int")
    tries = ((F.col("word"), half), (F.reverse("word"), length - half))
    start = [
        words.select(
            F.col("id").alias("word"), length.alias("length"), first_edit.alias("first_edit"),
            F.lit(root).cast("bigint").alias("node"), rest.alias("rest"), F.lit(0).alias("edits"),
        )
        for root, (rest, first_edit) in enumerate(tries)
    ]
    states = store.save(start[0].union(start[1]), "states/level=0")
    level = 0
    while states.rows:
        level += 1
        edges = store.save(_edges(states.df.where(F.col("edits") == 0)), f"edges{level}")
        if not edges.rows:
            break
        size = edges.df.agg(F.sum(F.octet_length("label")).alias("n")).first()["n"]
        states = store.save(_advance(states.df, edges, size), f"states/level={level}")
    found = store.save(_met(store.read("states")), "pairs").df
    return found.union(found.select("b", "a")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root) of all words with a form (id, to): each step doubles how far a word looks ahead."""
    now = staged(forms.select("id", F.col("to").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("beyond"))
        stepped = join_unique(now, ahead, "root", ["id"])
        now = staged(stepped.select("id", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("id", "root")
        now = now.drop("moved")


def spelling_groups(docs: DataFrame, rules: Words = Words()) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    store = TableStore(docs.sparkSession)
    words = store.save(word_counts(docs, rules).withColumn("id", F.monotonically_increasing_id()), "words").df
    pairs = near_pairs(words, store)
    other = words.select(F.col("id").alias("b"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    best = F.min(F.struct(-F.col("form_n"), F.col("form"), F.col("b")))
    near = pairs.join(other, "b").groupBy(F.col("a").alias("id")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = -F.col("best.col1") >= rules.dominance * F.col("n")
    joined = words.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.col1")).alias("form_n"),
        F.when(enough, F.col("best.b")).alias("to"),
    )
    chosen = store.save(joined, "chosen").df
    roots = _roots(chosen.where(F.col("to").isNotNull()).select("id", "to"))
    named = join_unique(roots, words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root", ["id"])
    grouped = chosen.join(named.select("id", "root_word"), "id", "left")
    return grouped.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
