"""Cross-tokenizer alignment against a token-by-token version, and the perfect hash under it."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import alignment
from ledgerloom.llm.perfect_hash import PerfectHash

COLUMNS = ("doc_id", *alignment.OUT, "groups")


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000, 60_000])
def test_a_perfect_hash_numbers_every_key_once(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 32, n, dtype=np.uint32))
    number = PerfectHash.from_bytes(PerfectHash.of(keys).to_bytes())
    assert sorted(number(keys).tolist()) == list(range(len(keys)))
    assert len(number.to_bytes()) <= 8 * (alignment.ID_BITS + 60) + len(keys)
    foreign = np.setdiff1d(rng.integers(0, 1 << 32, 1000, dtype=np.uint32), keys)
    assert ((number(foreign) >= -1) & (number(foreign) < max(1, len(keys)))).all()


def test_a_perfect_hash_refuses_repeated_keys():
    with pytest.raises(ValueError, match="distinct"):
        PerfectHash.of(np.array([5, 5], dtype=np.uint32))


class Brute:
    """Both tokenizers by the JSON file and the piece model, tokens compared one by one."""

    def __init__(self):
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer, decoders

        self.first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.first.encode_special_tokens = True
        # the printable stand-ins of the 256 bytes
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
        self.second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def a_bytes(self, i):
        return bytes(self.byte[c] for c in self.first.id_to_token(i))

    def b_bytes(self, i):
        piece = self.second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(self, text):
        if not text:
            return None
        a, b = self.first.encode(f" {text}", add_special_tokens=False).ids, self.second.encode(text)
        a_bytes, b_bytes = [self.a_bytes(i) for i in a], [self.b_bytes(i) for i in b]
        whole = f" {text}".encode()
        return (a, b, a_bytes, b_bytes) if b"".join(a_bytes) == whole == b"".join(b_bytes) else None

    def spans(self, pieces):
        at, out = 0, []
        for p in pieces:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    def describe(self, rows):
        links, texts = [], []
        for _, text in rows:
            found = self.tokens(text)
            if found is None:
                links.append(None)
                texts.append("")
                continue
            a, b, sa, sb = found[0], found[1], self.spans(found[2]), self.spans(found[3])
            own = [(x, y) for x, (p, q) in zip(a, sa) for y, (r, s) in zip(b, sb) if max(p, r) < min(q, s)]
            links.append((a, b, own))
            ends = sorted({q for _, q in sa} & {s for _, s in sb})
            parts, start = [], 0
            for end in ends:
                group = [[str(x) for x, (p, q) in zip(ids, spans) if start <= p and q <= end] for ids, spans in ((a, sa), (b, sb))]
                parts.append("|".join(",".join(side) for side in group))
                start = end
            texts.append(";".join(parts))
        count = Counter(pair for found in links if found for pair in found[2])
        top = Counter()
        for (_, y), n in count.items():
            top[y] = max(top[y], n)
        out = []
        for (key, _), found, text in zip(rows, links, texts):
            a, b, own = found or ([], [], [])
            out.append((
                key, len(a), len(b), text.count("|"), len(own), sum(count[p] == top[p[1]] for p in own),
                sum(count[p] for p in own), text,
            ))
        return out, count, top


@pytest.fixture(scope="module")
def brute():
    return Brute()


def texts():
    rng = random.Random(2)
    words = ["alignment", "of", "tokenizers", "naïve", "groß", "日本語", "🙂", "2024", "x=1;", "don't", "\t", "\n\n", "zz" * 9]
    some = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(40)]
    odd = [
        None, "", " ", "  lead", "trail  ", "a", "<|endoftext|>", "say <s> </s> <unk> <0x41>", "▁mark", "a\u0000b",
        "ﬁ ① ​", "é é", "!!!!" * 30, some[0], some[0],
    ]
    return list(enumerate(some + odd))


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 200, "together": 2, "buckets": 5}])
def test_alignment_equals_comparing_tokens_one_by_one(spark, brute, sizes):
    """In one chunk, and in many of which two are summed at a time."""
    rows = [*texts(), (None, "no key"), (3, "repeated key"), (3, "repeated key")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumns(
        {c: F.lit(1) for c in ("chunk", "bucket", "node", "n_a", "names")}
    )
    want, count, top = brute.describe(rows)
    found = alignment.align(docs, **sizes)
    assert sizes == {} or found.chunks > 10
    together = {"together": sizes["together"]} if sizes else {}
    got = [tuple(r) for r in found.documents(**together).select(*COLUMNS).collect()]
    by_text = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(got, key=by_text) == sorted(want, key=by_text)
    assert sum(r[1] == 0 for r in got) >= 3  # NULL, empty, and the mark that reads as a space
    pairs = {(r.a_id, r.b_id): (r["count"], r.best) for r in found.pairs().collect()}
    assert pairs == {p: (n, n == top[p[1]]) for p, n in count.items()}


def test_digests_are_of_the_groups(spark):
    docs = spark.createDataFrame(texts(), "doc_id BIGINT, text STRING")
    found = alignment.align(docs)
    plain = {r.doc_id: r.groups for r in found.documents().collect()}
    hashed = {r.doc_id: r.groups for r in found.documents(digest=True).collect()}
    assert hashed == {k: hashlib.sha256(g.encode()).hexdigest() if g else "" for k, g in plain.items()}


def test_a_very_long_text_and_an_empty_table(spark):
    text = "Repeated words of a long document, written again. " * 20_000
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id BIGINT, text STRING")
    got = {r.doc_id: r for r in alignment.align(docs, chunk_bytes=1000).documents().collect()}
    assert got[1].groups.count("|") == got[1].n_groups and got[1].n_links >= got[1].n_a > 100_000
    empty = alignment.align(docs.limit(0))
    assert empty.documents().count() == 0 and empty.pairs().count() == 0
    without = alignment.align(docs.select("doc_id", F.lit(None).cast("string").alias("text")))
    assert [r.n_a for r in without.documents().collect()] == [0, 0]
