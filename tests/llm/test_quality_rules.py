import base64
import random
import string

import pytest
import zstandard

from tallyhouse.llm.quality_rules import BANDS, Rules, judge, keep_good, quality_report
from tests.llm.brute import documents, prose, quality_counts

ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t\x0b\x0c\r\n"),
    (4, "a b c a b c\nx\nx\n \nx"),
    (5, "a a a a"),
    (6, "é ü <b>#*$%&|</b>   日本"),
    (7, prose(1, 300)),
    (7, prose(1, 300)),
    (8, "spam ham eggs " * 400),
    (None, prose(2, 120)),
    (9, prose(3, 40_000)),
]


def test_counts_match_brute_force(spark):
    draw = random.Random(5)
    rows = ODD + [(100 + k, "".join(draw.choice("ab \n#<") for _ in range(draw.randrange(400)))) for k in range(150)]
    got = quality_report(documents(spark, rows)).collect()
    found = [(r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in got]
    assert sorted(found, key=repr) == sorted([(i, quality_counts(t)) for i, t in rows], key=repr)


def test_prose_is_kept_and_repetition_is_not(spark):
    noise = random.Random(1)
    junk = " ".join("".join(chr(noise.randrange(33, 0x2FFF)) for _ in range(9)) for _ in range(3000))
    lines = "\n".join(prose(9, 60, 6)[:300] + f" {k}" for k in range(400))
    rows = [(1, prose(1, 200)), (2, prose(2, 3000)), (3, "the same thing again. " * 90), (4, lines), (5, prose(3, 49)), (6, junk)]
    kept = {r.doc_id: r.kept for r in quality_report(documents(spark, rows)).collect()}
    assert kept[1] and kept[2] and not kept[3] and not kept[4] and not kept[5]


def test_filter_keeps_all_columns_and_clashing_names(spark):
    docs = documents(spark, ODD).selectExpr("*", "1 AS kept", "'x' AS n_words", "array(1, null) AS ratio")
    assert keep_good(docs).schema == docs.schema
    assert {r.doc_id for r in keep_good(docs).collect()} == {7, 9, None}
    assert {r.doc_id for r in quality_report(docs).where("kept").collect()} == {7, 9, None}


def test_empty_table_and_rules(spark):
    assert quality_report(documents(spark, [])).count() == 0
    strict = Rules(min_words=1, max_bad_chunk_share=1.0)
    assert quality_report(documents(spark, [(1, "one two")]), strict).first().base_failed is False


@pytest.mark.parametrize("size", [100, 5000, 40_000])
def test_chunks_find_a_repetitive_stretch(spark, size):
    text = prose(4, 2000) + " " + ("zebra " * size) + prose(5, 200)
    row = quality_report(documents(spark, [(1, text)]), Rules(max_repeat_percent=100)).first()
    assert row.kept == (size == 100)


def random_words(draw, size):
    return " ".join("".join(draw.choices(string.ascii_letters + string.digits, k=7)) for _ in range(size // 8 + 1))[:size]


def base64_lines(draw, size):
    whole = base64.b64encode(draw.randbytes(size)).decode()
    width = 7 if size < 2 << 10 else 20 if size < 4 << 10 else 76
    return "\n".join(whole[at : at + width] for at in range(0, len(whole), width))[:size]


@pytest.mark.parametrize("make", [random_words, base64_lines])
@pytest.mark.parametrize("low", [band.below for band in BANDS[:-1]])
def test_random_letters_are_rejected_in_every_band(make, low):
    draw, packer = random.Random(low), zstandard.ZstdCompressor(level=3)
    high = next(min(band.below, 3 * low) for band in BANDS if band.below > low)
    for size in [max(low, 410), max(low, 410) // 2 + high // 2, high - 1]:
        found = judge(make(draw, int(size)), packer, Rules())
        assert not found[5] and not found[6], (size, found)


#: Article 1 and preamble of the Universal Declaration of Human Rights.
RIGHTS = {
    "en": "Whereas recognition of the inherent dignity and of the equal and inalienable rights of all members of the human family is "
    "the foundation of freedom, justice and peace in the world, whereas disregard and contempt for human rights have resulted in "
    "barbarous acts which have outraged the conscience of mankind. All human beings are born free and equal in dignity and rights. "
    "They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood.",
    "de": "Da die Anerkennung der angeborenen Würde und der gleichen und unveräußerlichen Rechte aller Mitglieder der Gemeinschaft der "
    "Menschen die Grundlage von Freiheit, Gerechtigkeit und Frieden in der Welt bildet. Alle Menschen sind frei und gleich an Würde "
    "und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt und sollen einander im Geist der Brüderlichkeit begegnen.",
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в "
    "отношении друг друга в духе братства. Каждый человек должен обладать всеми правами и всеми свободами, провозглашенными настоящей "
    "Декларацией, без какого бы то ни было различия, как-то в отношении расы, цвета кожи, пола, языка, религии, политических или иных "
    "убеждений, национального или социального происхождения, имущественного, сословного или иного положения.",
    "ko": "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로 형제애의 정신으로 "
    "행동하여야 한다. 모든 사람은 인종, 피부색, 성, 언어, 종교, 정치적 또는 기타의 견해, 민족적 또는 사회적 출신, 재산, 출생 또는 기타의 신분과 같은 "
    "어떠한 종류의 차별이 없이, 이 선언에 규정된 모든 권리와 자유를 향유할 자격이 있다. 모든 사람은 생명과 신체의 자유와 안전에 대한 권리를 가진다.",
}


@pytest.mark.parametrize("lang", RIGHTS)
def test_prose_of_other_languages_is_kept(lang):
    found = judge(RIGHTS[lang], zstandard.ZstdCompressor(level=3), Rules())
    assert not found[5] and found[6], found
