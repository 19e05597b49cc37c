"""Spelling variants against a plain comparison of all words, and against the SQL."""

import random
import re
import string
import zlib
from collections import Counter

import duckdb

from tallyhouse.llm import spelling_trie
from tallyhouse.llm.oracle import SPELLING_GROUPS
from tallyhouse.llm.spelling_trie import Words, spelling_groups

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def frame(spark, texts):
    return spark.createDataFrame([(i, text, 3, "clash") for i, text in texts], "doc_id long, text string, n long, word string").repartition(3)


def counted(texts):
    counts = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 5 and n >= 3}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    if len(short) == len(long):
        return sum(x != y for x, y in zip(short, long)) == 1
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(texts):
    words = counted(texts)
    near = {word: [other for other in words if is_near(word, other)] for word in words}
    best = {word: min(others, key=lambda o: (-words[o], o)) for word, others in near.items() if others}
    form = {word: other for word, other in best.items() if words[other] >= 2 * words[word]}
    rows = []
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        rows.append((word, form.get(word), root, n, len(near[word]), words.get(form.get(word))))
    return sorted(rows)


def found(spark, texts):
    return sorted(tuple(row[name] for name in COLUMNS) for row in spelling_groups(frame(spark, texts)).collect())


def variants(draw, word, letters):
    at = draw.randrange(len(word))
    return draw.choice([word[:at] + word[at + 1 :], word[:at] + draw.choice(letters) + word[at:], word[:at] + draw.choice(letters) + word[at + 1 :]])


def dense(seed, letters, size):
    """Texts over few letters, so that runs of equal letters and many neighbours occur."""
    draw = random.Random(seed)
    base = ["".join(draw.choices(letters, k=draw.randrange(4, 9))) for _ in range(size)]
    words = base + [variants(draw, word, letters) for word in base] + [word * 2 for word in base[:20]]
    return [(i, " ".join(draw.choices(words, k=120)) + " " + draw.choice(words).upper()) for i in range(60)]


def test_equals_comparing_all_words(spark):
    texts = dense(1, "ab", 40) + [(i + 100, text) for i, text in dense(2, "abcdeÀÿé×", 60)]
    assert found(spark, texts) == brute(texts)


def test_equals_sql(spark):
    texts = dense(3, "abcß", 80)
    database = duckdb.connect()
    database.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    database.executemany("INSERT INTO documents VALUES (?, ?)", texts)
    assert sorted(database.sql(f"SELECT {', '.join(COLUMNS)} FROM ({SPELLING_GROUPS})").fetchall()) == found(spark, texts)


def test_levels_too_large_to_be_sent_give_the_same(spark, monkeypatch):
    texts = dense(4, "abc", 30)
    monkeypatch.setattr(spelling_trie, "SENT_EDGES", 0)
    assert found(spark, texts) == brute(texts)


def test_long_words_with_a_common_beginning_need_few_levels(spark, monkeypatch):
    monkeypatch.setattr(spelling_trie, "PIECE", 1000)
    long = "abcdefghij" * 900
    words = [long, long[:-1], long + "x", "y" + long[1:], long[:4000] + "z" + long[4001:], long[:5000] + long[5001:]]
    texts = [(None, " ".join(words[: i + 2])) for i in range(6)] * 3
    saved = []
    save = spelling_trie.TableStore.save
    monkeypatch.setattr(spelling_trie.TableStore, "save", lambda self, df, name, *rest, **more: saved.append(name) or save(self, df, name, *rest, **more))
    assert found(spark, texts) == brute(texts)
    assert len([name for name in saved if name.startswith("edges")]) < 8


def test_edits_that_lead_to_no_word_are_not_stored(spark, monkeypatch):
    letters = string.ascii_lowercase
    # Two words below every letter: each is as long as all others, but hardly one goes on like another.
    words = [f"stems{c}{letters[(i + k) % 26]}{letters[(7 * i + k) % 26]}" for i, c in enumerate(letters) for k in (3, 8)]
    edited = []
    save = spelling_trie.TableStore.save

    def saved(self, df, name, *rest, **more):
        stored = save(self, df, name, *rest, **more)
        if name.startswith("states"):
            edited.append(stored.df.where("edits = 1").count())
        return stored

    monkeypatch.setattr(spelling_trie.TableStore, "save", saved)
    texts = [(None, " ".join(words))] * 3
    assert found(spark, texts) == brute(texts)
    assert sum(edited) < 100


def test_chains_of_forms_lead_to_the_last(spark):
    chain = {"wordaaaa": 3, "wordaaab": 6, "wordaabb": 12, "wordabbb": 24, "wordbbbb": 48}
    texts = [(None, " ".join([word] * n)) for word, n in chain.items()]
    assert {row[0]: row[2] for row in found(spark, texts)} == dict.fromkeys(chain, "wordbbbb")


def test_ties_and_thresholds(spark):
    texts = [(None, "words " * 3 + "wordz " * 6 + "worda " * 6 + "wordsy " * 5 + "abcd " * 9 + "twice once " * 2)]
    rows = {row[0]: row[1:] for row in found(spark, texts)}
    assert rows["words"] == ("worda", "worda", 3, 3, 6)
    assert rows["wordz"] == (None, "wordz", 6, 2, None)
    assert set(rows) == {"words", "wordz", "worda", "wordsy"}


def test_odd_rows(spark):
    texts = [(1, None), (2, ""), (3, "12 ... ñ"), (None, "Straße STRAßE straße"), (4, "x" * 300_000), (4, "x" * 300_000)]
    assert found(spark, texts) == brute(texts) == [("straße", None, "straße", 3, 0, None)]
    assert spelling_groups(frame(spark, [])).count() == 0


def test_damage_follows_the_hash():
    words = [next(spelling_trie.words_of(i, "Bäispiel", Words()))[0].decode() for i in range(2000)]
    hashes = [zlib.crc32(f"{i}:bäispiel".encode()) for i in range(2000)]
    assert words == ["bäispiel" if h % 97 else "bäispiel"[: h % 8] + "bäispiel"[h % 8 + 1 :] for h in hashes]
    assert 5 < sum(word != "bäispiel" for word in words) < 50
