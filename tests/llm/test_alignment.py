"""Alignment of two tokenizers against a plain reading, byte by byte."""

import collections
import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarnlake.llm import token_alignment
from tarnlake.llm.common import bounded_batches, stored

public_tokenizers = pytest.importorskip("public_tokenizers")
FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    """The contract read word for word, without numpy or Arrow."""

    def __init__(self):
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(FIRST)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=SECOND)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, bytes(self.letters[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        same = b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode()
        return (a, b) if same else ([], [])

    def rows(self, docs):
        read, total = [], collections.Counter()
        for doc, text in docs:
            a, b = self.tokens(text)
            spans = []
            for side in (a, b):
                at, out = 0, []
                for i, x in side:
                    out.append((i, at, at + len(x)))
                    at += len(x)
                spans.append(out)
            links, j = [], 0
            for i, s, e in spans[0]:
                while j < len(spans[1]) and spans[1][j][2] <= s:
                    j += 1
                k = j
                while k < len(spans[1]) and spans[1][k][1] < e:
                    links.append((i, spans[1][k][0]))
                    k += 1
            cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
            groups, low = [], 0
            for c in cuts:
                groups.append("|".join(",".join(str(i) for i, s, e in side if low < e <= c) for side in spans))
                low = c
            total.update(links)
            read.append((doc, len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
        top = collections.defaultdict(int)
        for (a, b), n in total.items():
            top[b] = max(top[b], n)
        return sorted(
            ((d, na, nb, ng, len(ls), sum(total[x] == top[x[1]] for x in ls), sum(total[x] for x in ls), sha) for d, na, nb, ng, ls, sha in read), key=str)


@pytest.fixture(scope="module")
def plain():
    return Plain()


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def odd_texts(prose):
    return [
        (1, "Hello tokenizer, hello world"), (2, None), (3, ""), (4, " "), (5, "  two  spaces \n\n lines\t"), (6, "naïve café 東京 \U0001F600 Łódź"),
        (7, "<|endoftext|> and <s> </s> <unk> <0x41>"), (8, "a ▁ b"), (9, "x ý \x00 z"), (10, "ａｂｃ ﬁne"), (None, "Hello world"),
        (1, "Hello tokenizer, hello world"), (1, "another text of the same id"), (11, prose(3, 4000)), (12, "q" * 5000), (13, "1234567890" * 300),
        (14, "\r\n\x0b\x0c "), (15, "﻿mark"), (16, "…—“quotes”")]


def test_every_column_equals_the_plain_reading(spark, docs, prose, plain):
    bounded_batches(spark)
    rows = odd_texts(prose)
    want = plain.rows(rows)
    assert sum(r[1] > 0 for r in want) > 12 and any(r[1] == 0 and r[0] == 8 for r in want)
    assert found(token_alignment.alignment(docs(rows).repartition(3), FIRST, PATTERN, SECOND)) == want


def test_the_way_beyond_the_broadcast_gives_the_same(spark, docs, prose, plain):
    rows = odd_texts(prose)
    assert found(token_alignment.alignment(docs(rows), FIRST, PATTERN, SECOND, broadcast_pairs=0)) == plain.rows(rows)


def test_tables_without_tokens(spark, docs):
    for rows in ([], [(1, None), (None, ""), (2, "a▁b")]):
        for bound in (0, 10):
            assert found(token_alignment.alignment(docs(rows), FIRST, PATTERN, SECOND, broadcast_pairs=bound)) == sorted(
                ((d, 0, 0, 0, 0, 0, 0, "") for d, _ in rows), key=str)


def test_partial_counts_are_handed_on_when_many(spark, docs, prose, monkeypatch):
    rows = stored(token_alignment.aligned(docs([(k, prose(k, 300)) for k in range(30)]), token_alignment.file_bytes(FIRST), PATTERN, token_alignment.file_bytes(SECOND)), "t")
    whole = token_alignment.pair_counts(rows)
    monkeypatch.setattr(token_alignment, "HELD_PAIRS", 10)
    assert token_alignment.pair_counts(rows).exceptAll(whole).isEmpty()
    assert whole.agg(F.sum("n")).first()[0] == rows.agg(F.sum("n_links")).first()[0]


def test_whole_query_on_the_small_table(spark, plain):
    from tarnlake.llm import registry

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert found(registry.QUERIES["op13_token_alignment"](spark, "/root/testdata/sf0.001")) == plain.rows(rows)


def test_entries_are_bytes_of_the_vocabularies():
    one = token_alignment.ByteLevel(token_alignment.byte_ranks(token_alignment.file_bytes(FIRST)), PATTERN)
    two = token_alignment.Pieces(token_alignment.file_bytes(SECOND))
    assert len(one.bytes) == 50256 and len(two.bytes) == 32000
    assert {bytes([b]) for b in range(256)} <= set(one.bytes.to_pylist())
    assert two.bytes[3 + 65].as_py() == b"A" and isinstance(one.lengths, pa.Array)


def test_ids_serve_as_ranks_over_the_whole_code_space(plain):
    """The first side's ids are those of the library, for every letter in several surroundings."""
    side = token_alignment.ByteLevel(token_alignment.byte_ranks(token_alignment.file_bytes(FIRST)), PATTERN)
    letters = [chr(c) for c in (*range(0xD800), *range(0xE000, 0x20000))]
    texts = ["".join(f"a{c}b {c}{c} 1{c}2 ?{c}! {c}'s\n{c} " for c in letters[k : k + 4]) for k in range(0, len(letters), 4)]
    library = plain.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
    assert [t for t, ids, e in zip(texts, side.encode(texts).to_pylist(), library) if ids != e.ids] == []
    broken = token_alignment.file_bytes(FIRST).replace(b'"ByteLevel","add_prefix_space":false', b'"ByteLevel","add_prefix_space":true')
    if broken != token_alignment.file_bytes(FIRST):
        with pytest.raises(ValueError, match="plain"):
            token_alignment.byte_ranks(broken)
