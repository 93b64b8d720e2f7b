"""Alignment of tokenizers against a plain version, token by token."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from textgauge.llm import alignment

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
RULE = alignment.Rule()


@pytest.fixture(scope="module")
def vocabularies():
    return alignment.vocabularies(*RULE.files())


def plain(rows, v):
    """The result for ``(doc_id, text)`` rows, by loops over byte places."""
    import sentencepiece
    from tokenizers import Tokenizer

    byte_json, model = RULE.files()
    whole = Tokenizer.from_str(byte_json.decode())
    whole.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    parsed, count = [], Counter()
    for doc_id, text in rows:
        a = whole.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        want = (" " + (text or "")).encode()
        if not text or b"".join(v.a_bytes[i] for i in a) != want or b"".join(v.b_bytes[i] for i in b) != want:
            a, b = [], []
        spans = []
        for ids, table in ((a, v.a_bytes), (b, v.b_bytes)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(own)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        ends = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups, low = [], 0
        for high in ends:
            groups.append("|".join(",".join(str(i) for s, e, i in own if low <= s < high) for own in spans))
            low = high
        parsed.append((doc_id, len(a), len(b), links, groups))
        count.update(set(links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return sorted(
        ((d, na, nb, len(g), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
          hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for d, na, nb, links, g in parsed), key=repr)


def aligned(spark, rows, rule=RULE):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"a": F.lit(1), "row": F.lit(2), "n": F.lit(3)})
    return sorted((tuple(r) for r in alignment.align(docs, rule).select(COLUMNS).collect()), key=repr)


ROWS = [
    (1, "The quick brown fox jumps over the lazy dog."), (2, None), (3, ""), (4, " "), (5, "The quick   brown\n\nfox"),
    (6, "zażółć gęślą jaźń 漢字 🙂 naïve"), (7, "a\x00b \x01"), (8, "<|endoftext|> </s> <unk> [INST] <0x41>"), (9, "lower ▁ one"),
    (10, "banana ananas anana"), (11, "é" * 40 + " x"), (1, "The quick brown fox jumps over the lazy dog."), (None, "the dog"),
    (12, "1234567 12 1 000"), (13, "tab\tand\r\nreturn sep"), (14, " " * 900 + "far"), (15, "don't we'll I'D"), (16, "ǅ ½ ़ ‍"),
]


def test_alignment_is_the_plain_one(spark, vocabularies):
    want = plain(ROWS, vocabularies)
    assert sum(r[1] > 0 for r in want) > 10
    assert aligned(spark, ROWS) == want
    # No pair in every task and few held at once: all go through the join.
    assert aligned(spark, ROWS, alignment.Rule(frequent=0, held=3)) == want
    assert aligned(spark, ROWS, alignment.Rule(frequent=20)) == want


def test_alignment_of_documents(spark, vocabularies):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").orderBy(F.length("text")).limit(150).collect()]
    got = sorted((tuple(r) for r in alignment.align(spark.createDataFrame(rows, "doc_id long, text string")).select(COLUMNS).collect()), key=repr)
    assert got == plain(rows, vocabularies)


def test_alignment_of_no_rows_and_long_text(spark, vocabularies):
    assert aligned(spark, []) == []
    assert aligned(spark, [(1, None)]) == [(1, 0, 0, 0, 0, 0, 0, "")]
    text = "some words of a long text, 12 of them. " * 20_000
    (row,) = aligned(spark, [(5, text)])
    assert row[1] > 100_000 and row[4] == row[1] + row[2] - row[3]
    assert row[5] == row[4] and row[6] == row[4]  # one text: every count is one


def test_both_byte_level_encoders_agree(vocabularies):
    """The ranks taken from the vocabulary file give the file's own encoding."""
    import random

    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(RULE.files()[0].decode())
    whole.encode_special_tokens = True
    draw = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "'s", "'S", "’s", "<|endoftext|>", "é", "漢字", "🙂", "‍", "Word", "1", ".", "\x85", "\xa0", "　", "ǅ", "½", "़", "\x00"]
    for _ in range(2000):
        text = " " + "".join(draw.choice(parts) for _ in range(draw.randint(0, 25)))
        assert vocabularies.a.encode_ordinary(text) == whole.encode(text, add_special_tokens=False).ids
