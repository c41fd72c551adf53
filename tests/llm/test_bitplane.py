"""Token shards: texts encoded in groups of any size give the library's ids, long ranges become several shards."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlens.llm import bitplane
from ledgerlens.session import scratch_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", " \n", "\x1c a\x1cb \x0b\x0c\x85 x", " a b　c !\x1c!", "<|x|> hello's <|endoftext|>tail", "Don't 12½ ÀÖ×÷ß", "a" * 3000 + " b", "Ünï ΑΣ ﬁ\n\nz"]


@pytest.mark.parametrize("group", [1, 64, 1 << 21])
def test_groups_give_the_ids_of_the_library(monkeypatch, group):
    monkeypatch.setattr(bitplane, "GROUP_BYTES", group)
    rnd = random.Random(group)
    texts = ODD + [" ".join(rnd.choice(ODD) + rnd.choice(["x.", "9'll", "É!"]) for _ in range(rnd.randint(0, 40))) for _ in range(60)]
    library = Tokenizer.from_file(VOCABULARY)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = bitplane.WordIds(VOCABULARY)
    encoder.words.most = encoder.pieces.most = 2000  # generations change all the time
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode([t.encode() for t in texts])]
    assert got == want
    assert list(encoder.encode([])) == []
    assert [list(b) for b in encoder.encode([b"\xff\xfe bad"])] == [list(b) for b in encoder.encode(["�� bad".encode()])]


def test_long_ranges_become_several_shards(spark):
    rows = [(k if k % 5 else None, "word " * (k % 9)) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(bitplane.encode_corpus(docs, VOCABULARY).collect(), key=lambda r: r.start)
    root = scratch_path(spark, "bitplane-test")
    shards = bitplane.write_shards(docs, root, VOCABULARY, shard_ids=20)
    found = shards.collect()
    assert max(r.part for r in found) > 0 and sum(r.n_docs for r in found) == 80
    assert max(r.n_ids for r in found) >= 20 and sum(r.n_ids for r in found) == whole[-1].start + whole[-1].n_tokens
    got = sorted(bitplane.read_shards(shards, root).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in whole]
