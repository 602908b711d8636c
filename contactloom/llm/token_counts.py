"""Token counts from the distinct pre-tokens of the corpus, without token ids for any document."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import spread
from .blocks import Block, as_bytes, bucket_count, encoded, looked_up, summed
from .scratch import write_table

# The split of byte-level BPE before its merges, and the same for texts whose
# characters beyond ASCII are all letters.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SINGLE_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"""  # where no blank follows another
PLAIN_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ɏ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ɏ]+|\s+(?!\S)|\s+"""
#: Characters on whose class the two splits, or two Unicode versions, may not agree.
NOT_PLAIN = re.compile("[\x1c-\x1f\u0080-¿×÷ɐ-\U0010ffff]")
LONG_RUN = 400
TWO_BLANKS, LONG_BLANK = re.compile(r"\s\s|\s\Z"), re.compile(r"(?<!\s)\s{%d}" % LONG_RUN)


def pre_tokens(tokenizer) -> Callable[[str], list[str]]:
    """The tokenizer's own split of a text without special strings; a plain text takes a faster regex."""
    plain, own = re.compile(PLAIN_SPLIT).findall, tokenizer.pre_tokenizer.pre_tokenize_str

    def split(text: str) -> list[str]:
        if NOT_PLAIN.search(text) is None:
            return plain(text)
        return [text[a:b] for _, (a, b) in own(text)]

    return split


@dataclass(frozen=True)
class Spec:
    """What tasks need of a tokenizer's file, read once on the driver: its text, special strings, and byte ranks if they may stand in for its merges."""

    text: str
    special: tuple[str, ...]
    ranks: dict[bytes, int] | None

    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.text)

    @property
    def width(self) -> int:
        """Bytes of an id."""
        return 2 if max(json.loads(self.text)["model"]["vocab"].values(), default=0) < 1 << 16 else 4


def load(path: str) -> Spec:
    """A .json file; it must be byte-level BPE with its usual split and no normalizer."""
    text = open(path, encoding="utf-8").read()
    kind = json.loads(text)
    before = kind.get("pre_tokenizer") or {}
    if kind["model"]["type"] != "BPE" or kind.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        raise ValueError("pre-token counting needs a byte-level BPE tokenizer without normalizer and prefix space")
    return Spec(text, tuple(t["content"] for t in kind.get("added_tokens", [])), _byte_ranks(kind["model"]))


def _byte_ranks(model: dict) -> dict[bytes, int] | None:
    """The vocabulary's pieces as bytes, if merging by rank gives the ids that merging by pairs gives; else null.

    That is so if ids follow the order of the merges and every piece is reached by its own merges: then
    two neighbours that make up a piece are always the pair of its last merge.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed values: bytes that stand for themselves
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    vocabulary, rank = model["vocab"], {p: i for i, p in enumerate(pairs)}
    if any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)) or any(c not in vocabulary for c in byte_of):
        return None

    def reached(piece: str) -> bool:
        parts = list(piece)
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda p: rank.get(p, len(rank)))
            if best not in rank:
                return False
            joined, i = [], 0
            while i < len(parts):
                both = tuple(parts[i : i + 2]) == best
                joined.append("".join(best) if both else parts[i])
                i += 1 + both
            parts = joined
        return True

    if not all(reached(a + b) for a, b in pairs):
        return None
    return {bytes(map(byte_of.__getitem__, piece)): i for piece, i in vocabulary.items() if i < 256 + len(pairs)}


def ids_of(spec: Spec) -> Callable[[str], list[int]]:
    """A text's ids as the library gives them.

    The same merges over byte ranks give the same ids several times faster, most of all where no blank follows
    another and the split needs no look ahead; texts with characters on whose class two splits may not
    agree, special strings or very long runs go to the library itself.
    """
    tokenizer, special = spec.tokenizer(), spec.special
    if not spec.ranks:
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    full, single = (tiktoken.Encoding("ranks", pat_str=p, mergeable_ranks=spec.ranks, special_tokens={}).encode_ordinary for p in (SPLIT, SINGLE_SPLIT))

    def ids(text: str) -> list[int]:
        if NOT_PLAIN.search(text) or any(s in text for s in special) or max(map(len, text.split()), default=0) >= LONG_RUN:
            return tokenizer.encode(text, add_special_tokens=False).ids
        if TWO_BLANKS.search(text) is None:
            return single(text)
        return tokenizer.encode(text, add_special_tokens=False).ids if LONG_BLANK.search(text) else full(text)

    return ids


def chunk_split(special: tuple[str, ...]) -> Callable[[str], list[str] | None]:
    """Cuts a text before single spaces, where pre-tokens always end; None if the text has another shape."""
    odd = re.compile("|".join([r"  | \Z", *map(re.escape, special)]))

    def cut(text: str) -> list[str] | None:
        if not text or odd.search(text) or NOT_PLAIN.search(text):
            return None
        first, *rest = text.split(" ")
        return [*([first] if first else []), *[" " + c for c in rest]]

    return cut


def _encoder(spec: Spec) -> Callable:
    """``encode(block, text)``: the text's bytes and the codes of all its pre-tokens."""
    special = spec.special
    split, cut = pre_tokens(spec.tokenizer()), chunk_split(special)
    marks = re.compile("|".join(f"({re.escape(s)})" for s in special)) if special else None

    def codes_of(block: Block, pieces: list[str]) -> bytes:
        return np.fromiter((block.code(p.encode()) for p in pieces), "<u4", len(pieces)).tobytes()

    def encode(block: Block, raw: bytes) -> tuple[int, np.ndarray]:
        text, memo = raw.decode(), block.memo
        chunks = cut(text)
        if chunks is None:
            parts = [p for p in (marks.split(text) if marks else [text]) if p]
            found = b"".join(codes_of(block, [p] if marks and marks.fullmatch(p) else split(p)) for p in parts)
        else:
            for c in set(chunks).difference(memo):
                memo[c] = codes_of(block, split(c))
            found = b"".join(map(memo.__getitem__, chunks))
        return len(raw), np.frombuffer(found, "<u4")

    return encode


def frequencies(docs: DataFrame, spec: Spec, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """Documents as pre-token frequencies, and the dictionaries of their blocks, by ``blocks``."""
    sent = docs.sparkSession.sparkContext.broadcast(spec)  # one tokenizer file
    return encoded(spread(docs.select(*as_bytes(docs, id_col, text_col))), lambda: _encoder(sent.value), bucket_count(docs), block_bytes)


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 16 << 20) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row of ``docs``, as the tokenizer's library counts whole texts.

    Special strings inside texts are one token each, the library's default.  Every distinct pre-token of
    the corpus is counted once, by the library, and joined to the documents' pre-token frequencies.
    Null and empty texts have no tokens; repeated rows get a row each; an empty table gives an empty
    result; other columns are ignored.
    """
    spec = load(tokenizer_path)
    sent = docs.sparkSession.sparkContext.broadcast(spec)
    held: list[Callable] = []  # one encoder for all buckets of a task

    def tokens_of(pieces: list[bytes]) -> np.ndarray:
        if not held:
            held.append(sent.value.tokenizer().encode_batch_fast)
        found = np.empty(len(pieces), np.int64)
        for at in range(0, len(pieces), 5000):
            part = [p.decode() for p in pieces[at : at + 5000]]
            found[at : at + len(part)] = [len(e.ids) for e in held[0](part, add_special_tokens=False)]
        return found

    table = write_table(frequencies(docs, spec, id_col, text_col, block_bytes), "pre-tokens")
    return summed(table, looked_up(table, tokens_of)).select("doc_id", F.col("fact").alias("n_bytes"), F.col("total").alias("n_tokens"))
