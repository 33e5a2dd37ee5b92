"""Operator 13 against the tokenizer library, text by text."""

from __future__ import annotations

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from outcomelake.llm import packing
from outcomelake.llm.common import table
from outcomelake.llm.queries import op13_packing
from llm_fixtures import make_docs, no_docs, odd_docs, prose  # noqa: F401

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
LIBRARY.encode_special_tokens = True


def expected(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, texts, capacity=1024):
    """Pieces tile their documents and sequences; the share of padding."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        documents[r.doc_id].append(r)
    padding = 0
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == np.cumsum([0] + [p.length for p in pieces])[:-1].tolist()
        used = sum(p.length for p in pieces)
        assert 0 < used <= capacity
        padding += 0 if used & (used - 1) == 0 else capacity - used
    assert set(documents) == set(texts)
    for key, pieces in documents.items():
        left = defaultdict(list)
        for p in pieces:
            left[p.start].append(p)
        for text in texts[key]:  # an id may be that of several documents
            ids, at = expected(text), 0
            while at < len(ids):
                raw = lambda p: np.array(ids[at:at + p.length], "<u4").tobytes()  # noqa: B023, E731
                mine = next(p for p in left[at] if p.doc_tokens == len(ids) and (bytes(p.ids) == raw(p) if "ids" in p else p.ids_crc32 == zlib.crc32(raw(p))))
                left[at].remove(mine)
                at += mine.length
            assert at == len(ids)
        assert not any(left.values())
    return padding / max(1, sum(r.length for r in rows))


def by_id(rows):
    texts = defaultdict(list)
    for r in rows:
        texts[r.doc_id].append(r.text)
    return texts


@pytest.mark.parametrize("capacity,finest", [(1024, 64), (64, 1), (8, 8), (1, 1)])
def test_pieces_of_odd_texts(odd_docs, capacity, finest):
    rows = packing.pack(odd_docs, capacity=capacity, finest=finest).collect()
    share = check(rows, by_id(odd_docs.collect()), capacity)
    assert share < 0.02 and (finest > 1 or share == 0)


def test_slices_as_the_library_makes_them(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "WINDOW", 40)
    rng = random.Random(5)
    marks = ["'ll", "'l", "'", "''s", " ", "  ", "\n", "\t\n ", "é", "ñandú", "漢字", "٣4", "!", " ?!", "<|endoftext|>", "՘", "\U00010940", "A1b2", "\x85", "　x", "\x1c"]
    texts = ["".join(rng.choice(marks + [prose(rng, 3)]) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    rows = packing.pack(make_docs(list(enumerate(texts))).repartition(3)).collect()
    assert check(rows, {i: [t] for i, t in enumerate(texts)}) < 0.03


def test_other_tokenizers_encode_whole_texts(tmp_path):
    """A tokenizer that does not slice byte-level text is left to the library."""
    raw = json.loads(open(public_tokenizers.path("byte_bpe_50k.json")).read())
    raw["pre_tokenizer"]["add_prefix_space"] = True
    tokens, library = packing.SliceTokens(json.dumps(raw).encode()), Tokenizer.from_str(json.dumps(raw))
    for text in ("one two", "'ll é\n"):
        assert np.frombuffer(tokens.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_every_common_character_is_sliced_alike():
    tokens = packing.SliceTokens(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    for c in map(chr, range(ord(packing.COMMON) + 1)):
        probe = f"a{c}1{c}!{c} {c}x{c}"
        theirs = [probe[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(probe)]
        assert tokens.common_slices.findall(probe) == theirs == tokens.slices.findall(probe)


def test_empty_tables_and_clashing_columns(spark, no_docs, odd_docs):
    assert packing.pack(no_docs).collect() == []
    more = odd_docs.selectExpr("text AS ids", "*", "doc_id AS start", "1 AS sequence_id", "0 AS length")
    assert len(packing.pack(more).collect()) == len(packing.pack(odd_docs).collect())
    named = spark.createDataFrame([("a", "one two"), ("b", None)], "key string, body string")
    assert {r.doc_id for r in packing.pack(named, "body", "key", end_id=None).collect()} == {"a"}
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(odd_docs, capacity=1000)


def test_sequences_hold_the_pieces(odd_docs):
    pieces = packing.pack(odd_docs)
    made = {r.sequence_id: r for r in packing.sequences(pieces, pad_id=7).collect()}
    found = defaultdict(list)
    for r in sorted(pieces.collect(), key=lambda r: r.offset):
        found[r.sequence_id] += np.frombuffer(r.ids, "<u4").tolist()
    assert set(made) == set(found)
    for key, ids in found.items():
        n = len(ids)
        padding = 0 if n & (n - 1) == 0 else 1024 - n
        assert made[key].ids == ids + [7] * padding and (made[key].n_tokens, made[key].n_padding) == (n, padding)


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = op13_packing(spark, "/root/testdata/sf0.001").collect()
    assert check(rows, by_id(docs.collect())) < 0.005
