"""The backoff automaton against the model's formula written out in Python, and its probabilities against one."""

import math
import zlib
from collections import Counter

import pandas as pd
import pytest

from tableferry.llm import backoff
from tests.conftest import SF_SMALL


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in low).split(" ") if w] + ["</s>"]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


class Formula:
    def __init__(self, texts, orders=backoff.ORDERS, prior=backoff.PRIOR):
        self.orders, self.prior = orders, prior
        self.c, self.total = Counter(), 0
        for text in texts:
            t = ["<s>", *tokens(text)]
            self.total += len(t) - 1
            for n in range(1, orders + 1):
                self.c.update(tuple(t[i : i + n]) for i in range(len(t) - n + 1))
        self.words = [k[0] for k in self.c if len(k) == 1 and k != ("<s>",)]

    def p(self, history, word):
        if not history:
            return (self.c[(word,)] + 1) / (self.total + len(self.words) + 1)
        lower = self.p(history[1:], word)
        return (self.c[history + (word,)] + self.prior * lower) / (self.c[history] + self.prior) if self.c[history] else lower

    def score(self, text):
        t = ["<s>", *tokens(text)]
        return sum(math.log10(self.p(tuple(t[max(0, i - self.orders + 1) : i]), t[i])) for i in range(1, len(t)))

    def row(self, doc_id, text):
        t = tokens(text)
        base = sum(math.log10(self.p((), w)) for w in t)
        return doc_id, held(doc_id), len(t), sum((w,) in self.c for w in t), self.total, base, self.score(text)


def odd_documents():
    texts = [None, "", " \n", "Word", "word WORD word", "a b c a b c a b d", "ä Ä 漢 ä", "a " * 300, " ".join(f"w{i * i % 97}" for i in range(3000)), "a b c a b c a b d"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b e"), (None, None), (5, "a b c a b c a b d")] + [(100 + i, f"a b w{i % 5} c w{i % 3}") for i in range(40)]
    return pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": [r[1] for r in rows], "key": 1, "block": 2, "score": "s", "row": 0, "held": "x"})


def close(got, expected):
    assert len(got) == len(expected)
    for a, b in zip(sorted(got, key=str), sorted(expected, key=str)):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9), (a, b)


@pytest.mark.parametrize("limit, orders", [(backoff.BLOCK_TOKENS, 2), (backoff.BLOCK_TOKENS, 3), (7, 3), (1, 2), (1, 3), (2, 1)])
def test_scores_of_odd_texts(spark, tmp_path, monkeypatch, limit, orders):
    frame = odd_documents()
    frame.to_parquet(tmp_path / "documents.parquet")
    rows = [(None if pd.isna(d) else int(d), t) for d, t in zip(frame.doc_id, frame.text)]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(backoff, "BLOCK_TOKENS", limit)
    if limit < 100:  # blocks that cut texts anywhere
        docs, rows = docs.where("length(text) < 100 OR text IS NULL"), [(d, t) for d, t in rows if len(t or "") < 100]
    formula = Formula([t for d, t in rows if not held(d)], orders)
    is_held = backoff.F.crc32(backoff.F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    blocks = backoff.blocks(docs, held_out=is_held, orders=orders)
    got = backoff.score(blocks, backoff.counts(blocks, orders), orders).drop("row")
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    close([tuple(r) for r in got.collect()], [formula.row(d, t) for d, t in rows])


def test_query_on_given_texts(spark):
    import duckdb

    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()
    formula = Formula([t for d, t in rows if not held(d)])
    got = [tuple(r) for r in backoff.q_op13(spark, SF_SMALL).collect()]
    close(got, [formula.row(d, t) for d, t in rows])
    assert sum(r[6] for r in got if r[1]) > sum(r[5] for r in got if r[1])  # histories help on texts not learnt from


def test_probabilities_sum_to_one():
    formula = Formula(["a b c", "a b", "b c a", None], 3)
    for history in [(), ("<s>",), ("a",), ("a", "b"), ("zzz",), ("<s>", "a")]:
        assert sum(formula.p(history, w) for w in [*formula.words, "unknown"]) == pytest.approx(1)


def test_no_training_text_and_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    blocks = backoff.blocks(docs, held_out=backoff.F.lit(True))
    assert {tuple(r)[1:] for r in backoff.score(blocks, backoff.counts(blocks)).collect()} == {(1, True, 3, 0, 0, 0.0, 0.0), (2, True, 1, 0, 0, 0.0, 0.0)}
    docs.where("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert backoff.q_op13(spark, str(tmp_path)).collect() == []
