import public_tokenizers
from brute import AWKWARD
from tokenizers import Tokenizer

from contactloom.llm import blocks, queries, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_query_counts_as_the_library(spark):
    folder = "/root/testdata/sf0.001"
    tokenizer = Tokenizer.from_file(PATH)
    want = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        want[r.doc_id] = (len((r.text or "").encode()), n, n > 1024)
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.QUERIES["op4_token_counts"](spark, folder).collect()} == want


def test_awkward_rows(awkward, empty):
    tokenizer = Tokenizer.from_file(PATH)
    want = sorted((i or -1, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in AWKWARD)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(awkward, PATH, block_bytes=200).collect()) == want
    assert token_counts.count_tokens(empty, PATH).collect() == []


def test_every_pre_token_meets_the_join(spark):
    """The distinct pre-tokens of all blocks, single vocabulary pieces included, are those of the library's split."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    split = Tokenizer.from_file(PATH).pre_tokenizer.pre_tokenize_str
    want = {r.text[a:b] for r in docs.collect() for _, (a, b) in split(r.text or "")}
    table = token_counts.frequencies(docs, token_counts.load(PATH), "doc_id", "text", 1 << 16)
    assert {p.decode() for r in table.where("bucket is not null").select("pieces").collect() for p in blocks.unpack(r.pieces)} == want


def test_ranks_stand_in_for_merges_only_where_every_piece_is_reached():
    letters = {chr(b): i for i, b in enumerate([*range(33, 127), *range(161, 173), *range(174, 256), *range(256, 324)])}
    merges = [("a", "b"), ("b", "c"), ("ab", "c")]
    model = {"vocab": letters | {a + b: 256 + i for i, (a, b) in enumerate(merges)}, "merges": [list(m) for m in merges]}
    assert token_counts._byte_ranks(model)[b"abc"] == 258
    merges[2] = ("a", "bc")  # "abc" merges to "ab", "c" first and never becomes one piece
    model = {"vocab": letters | {a + b: 256 + i for i, (a, b) in enumerate(merges)}, "merges": [list(m) for m in merges]}
    assert token_counts._byte_ranks(model) is None
