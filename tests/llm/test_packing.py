import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from brute import AWKWARD
from tokenizers import Tokenizer

from contactloom.llm import packing, queries
from contactloom.llm.token_counts import load

PATH = public_tokenizers.path("byte_bpe_50k.json")


def checked(rows, texts):
    """Every id of every document in exactly one piece, sequences without gaps and full or of a power of two."""
    tokenizer = Tokenizer.from_file(PATH)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for d, pieces in by_doc.items():
        ids = [*tokenizer.encode(texts[d] or "", add_special_tokens=False).ids, 0]
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    return padding, sum(r.length for r in rows)


def test_query_packs_every_id_once(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    padding, total = checked(queries.QUERIES["op2_curve_packing"](spark, folder).collect(), texts)
    assert padding <= 0.01 * total


def test_awkward_rows(awkward, empty):
    once = {i: t for i, t in AWKWARD if i not in (8, None)}
    rows = packing.pack(awkward, PATH).collect()
    checked_rows = [r for r in rows if r.doc_id in once]
    tokenizer = Tokenizer.from_file(PATH)
    for d, t in once.items():
        assert sum(r.length for r in checked_rows if r.doc_id == d) == len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
    assert sum(r.length for r in rows if r.doc_id == 8) == 2 * (len(tokenizer.encode(dict(AWKWARD)[8]).ids) + 1)
    assert packing.pack(empty, PATH).collect() == []


def test_hilbert_curve_visits_every_cell_by_neighbours():
    points = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = packing.hilbert(points, 3)
    assert sorted(keys) == list(range(512))
    walk = points[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_fast_ids_are_those_of_the_library_on_noise():
    import random

    draw, encode, tokenizer = random.Random(11), packing._encoder(load(PATH)), Tokenizer.from_file(PATH)
    pieces = ["the", " ing", "q", "zx", "'ll", "'", "’", "é", "ß", "  ", "\n\n", "\t", "123", "<|endoftext|>", "\U0001f600", "aaaa", "ﬁ", "١٢", "_", "%%%", "\x1c", "\x85", " ", "x" * 500, " " * 450]
    for _ in range(3000):
        text = "".join(draw.choices(pieces, k=draw.randint(0, 12))) + "".join(draw.choices("abcdefghijklmnopqrstuvwxyzäöüéèñ ", k=draw.randint(0, 40)))
        assert encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes(), text


def test_ids_are_the_library_s():
    """By either split, and by the library itself for odd texts."""
    tokenizer, encode = Tokenizer.from_file(PATH), packing._encoder(load(PATH))
    texts = [t or "" for _, t in AWKWARD] + [" lead", "a  b", "tail ", "x\n y", "it's 'quoted' we'll ", "ünï cödé", "tab\tx", "#1 a-b", "word " * 3 + "end", "<|endoftext|> and on", "x" * 399, "y" * 401, "a" + " " * 450 + "b", "one\ttwo\nthree", "don't can't", "\n"]
    for t in texts + texts:
        assert np.frombuffer(encode(t), "<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t
