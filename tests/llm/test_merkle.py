import hashlib
import zlib

import pytest
from brute import AWKWARD
from pyspark.sql import functions as F

from contactloom.llm import merkle, queries

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """The nodes' levels, plainly, up to the one that is left."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, at):
    for level in tree[:-1]:
        run = level[at // 8 * 8 : at // 8 * 8 + 8]
        yield run[: at % 8], run[at % 8 + 1 :]
        at //= 8


def plain(rows, tamper):
    """A row's facts by brute force; rows are (doc_id, source, lang, n_chars, text)."""
    parts: dict = {}
    for row in rows:
        parts.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), leaf(tamper(row))))
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {p: climb([x[2] for x in sorted(parts[p])]) for p in names}
    over = climb([trees[p][-1][0] for p in names])
    out = []
    for place, p in enumerate(names):
        for at, (known, doc_id, own, claim) in enumerate(sorted(parts[p])):
            proof, now = "", claim
            for left, right in [*path(trees[p], at), *path(over, place)]:
                proof, now = proof + "".join(left + right), h(*left, now, *right)
            out.append((doc_id if known else None, own, trees[p][-1][0], over[-1][0], h(proof), now, now == over[-1][0]))
    return sorted(out, key=repr)


def lowered(row):
    lower = row[4] is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
    return (*row[:4], row[4].translate({c: c + 32 for c in range(65, 91)})) if lower else row


def told(table):
    return sorted([tuple(r) for r in table.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()], key=repr)


def claims():
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return {"text": F.when(tampered, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))}


def test_query_is_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select(*COLUMNS).collect()]
    got = queries.QUERIES["op12_merkle_manifest"](spark, folder).withColumnRenamed("doc_id", "id")
    want = plain(rows, lowered)
    assert told(got) == want and 0 < sum(not w[-1] for w in want) < len(want)


@pytest.mark.parametrize("rounds", [1, 2])
def test_awkward_rows_small_blocks_and_many_parts(spark, rounds, monkeypatch):
    """Blocks of 8 and 64 leaves, so trees have several stages; null and empty parts, repeated rows and ids, clashing names."""
    monkeypatch.setattr(merkle, "ROUNDS", rounds)
    monkeypatch.setattr(merkle, "BLOCK", 8**rounds)
    langs = [None, "", "en", "é", "Z"] + [f"p{i}" for i in range(70)]
    rows = [(i, "s", langs[k % len(langs)] if k % 3 else "en", None if k % 5 else k, t) for k, (i, t) in enumerate(AWKWARD * 14)]
    rows += [(8, None, "en", 1, "Same")] * 40
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, source string, lang string, n_chars int, text string, part int, at int, node string").repartition(5)
    # Tasks get the functions by value, so they work with these blocks too.
    assert told(merkle.manifest(docs, COLUMNS, "lang", "doc_id", claims()).audit()) == plain(rows, lowered)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 4096, 4097])
def test_trees_of_all_sizes(spark, n):
    rows = [(i, "s", "en", 1, f"Text {i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    assert told(merkle.manifest(docs, COLUMNS, "lang", "doc_id", claims()).audit()) == plain(rows, lowered)


def test_a_proof_folds_to_the_root(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    manifest = merkle.manifest(docs, COLUMNS, "lang", "doc_id")
    rows = manifest.audit(proofs=True).collect()
    assert len(rows) == docs.count()
    for r in rows:
        now = r.leaf
        for slot, others in zip(r.slots, r.siblings):
            now = h(others[: slot * 64], now, others[slot * 64 :])
        assert now == manifest.root == r.folded_root and r.verified and h(*r.siblings) == r.proof_sha256


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars int, text string")
    manifest = merkle.manifest(docs, COLUMNS, "lang", "doc_id")
    assert manifest.root is None and manifest.audit().collect() == [] and manifest.audit(proofs=True).collect() == []
