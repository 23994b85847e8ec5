"""BPE encoding and decoding: exact merges in linear time by backtracking over longest matches, and table decoding.

A word is encoded from the longest vocabulary entries that an Aho-Corasick automaton finds at each position. A token may
follow another only if no merge of lower rank would have crossed their border (the pair-compatibility table); where none
fits, the encoder goes back one token and tries its next shorter prefix. Positions that proved dead are never tried again,
so the work is linear in the word's length. Decoding gathers bytes from one buffer through an offset table.

Defined results: a null text counts as empty; an empty text has no tokens and decodes to the empty text; equal rows get
equal results; null and repeated ids keep a row each; texts of any length are encoded whole; an empty table gives an empty result; other
columns of the input are ignored or carried, whatever their names (``lengths`` replaces ``n_tokens``).
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import slices
from .rows import free_name
from placeloom.plans.scratch import ship

_END = ""
_loaded: dict[str, BacktrackingBPE] = {}


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class _Seen(dict):
    """Ids, as bytes, of the parts and words seen so far; of bounded size."""

    def __init__(self, bpe: BacktrackingBPE):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, part: str) -> bytes:
        bpe = self.bpe
        if part in bpe.special:
            return self.keep(part, np.array([bpe.special[part]], np.int32).tobytes())
        words = bpe.words(part)
        got = b"".join([self.get(w) or self.keep(w, bpe.encode_piece(w)) for w in words])
        return got if words == [part] else self.keep(part, got)

    def keep(self, part: str, ids: bytes) -> bytes:
        if len(self) >= self.bpe.CACHE:
            self.clear()
        if len(part) < 64:
            self[part] = ids
        return ids


class BacktrackingBPE:
    """Encoder and decoder for a vocabulary file of the ``tokenizers`` library: BPE over byte-level words with word ends."""

    CACHE = 200_000  # parts of text kept; beyond that the table starts again

    def __init__(self, spec: dict):
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        vocab: dict[str, int] = model["vocab"]
        mark = lambda t: t[: -len(suffix)] + _END if suffix and t.endswith(suffix) else t
        self.text: dict[int, str] = {i: mark(t) for t, i in vocab.items() if t not in self.special}
        ids = {t: i for i, t in self.text.items()}
        self.merge: dict[tuple[int, int], int] = {}  # pair -> merged token
        self.rank: dict[int, int] = {}  # token -> rank of its merge; characters have none
        self.parts: dict[int, tuple[int, int]] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b = ids[mark(a)], ids[mark(b)]
            whole = ids[self.text[a] + self.text[b]]
            self.merge[a, b] = whole
            if whole not in self.rank:
                self.rank[whole], self.parts[whole] = r, (a, b)
        self.automaton = ahocorasick.Automaton()
        for i, t in self.text.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        #: The longest shorter token that starts a token, -1 for none.
        self.wide = 1 + max(self.text)
        self.shorter, self.size = [-1] * self.wide, [0] * self.wide
        for i, t in self.text.items():
            self.shorter[i] = next((ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in ids), -1)
            self.size[i] = len(t)
        self.fits: dict[int, bool] = {}  # left * wide + right
        shown = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        pieces = [(shown.get(i, "") + " ").encode() for i in range(max(shown) + 1)]
        self.offset = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        self.buffer = np.frombuffer(b"".join(pieces), np.uint8)
        self.decimal = [str(i) for i in range(len(pieces))]
        self.alphabet = byte_alphabet()
        self.seen = _Seen(self)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        # ranges serve where all letters are Latin and all numbers [0-9]; else the classes that the file names
        self.plain = re.compile(r"[a-zªµºÀ-ÖØ-öø-ɏ]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\sa-z0-9ªµºÀ-ÖØ-öø-ɏ]+")
        self.full = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.odd = re.compile(r"[^\x20-\x7e\n\t\r\xa1-\xb1\xb4-\xb8\xba-\xbb\xbf-ɏ‐-‧]")

    @classmethod
    def load(cls, path: str) -> BacktrackingBPE:
        if path not in _loaded:
            _loaded[path] = cls(json.loads(Path(path).read_text(encoding="utf-8")))
        return _loaded[path]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the text of ``left`` and ``right`` together would end in just these two tokens.

        Undo the later of the two tokens' merges again and again, on the side that faces the border; the pair is broken if
        at some stage the two facing pieces would themselves have merged before that undone merge took place.
        """
        a, b, merge, rank = left, right, self.merge, self.rank
        before_a = before_b = 1 << 60  # ranks at which the facing pieces were swallowed by larger ones
        fits = True
        while True:
            whole = merge.get((a, b))
            if whole is not None:
                r = rank[whole]
                if r < before_a and r <= before_b:  # of equal ranks the one further left comes first
                    fits = False
                    break
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                break
            if ra >= rb:
                before_a, a = ra, self.parts[a][1]
            else:
                before_b, b = rb, self.parts[b][0]
        if len(self.fits) > 200_000:
            self.fits.clear()
        self.fits[left * self.wide + right] = fits
        return fits

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Tokens of one word in the byte alphabet, without its end mark."""
        text = word + _END
        n = len(text)
        longest = [-1] * (n + 1)
        size, shorter, fits, wide = self.size, self.shorter, self.fits, self.wide
        for end, i in self.automaton.iter(text):
            longest[end - size[i]] = i  # a later end is a longer match; start 0 is kept at -1
        token = longest[-1]
        if size[token] == n:
            return (token,)
        dead = bytearray(n + 1)
        dead[n - 1] = 1  # the end mark belongs to the last character
        out = [-1]
        last, at = -1, 0
        while at < n:
            while token >= 0:
                end = at + size[token]
                if not dead[end]:
                    if last < 0:
                        break
                    ok = fits.get(last * wide + token)
                    if ok or ok is None and self.compatible(last, token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                last, at = token, end
                token = longest[at - 1]
            else:
                dead[at] = 1
                token = out.pop()
                if token < 0:
                    raise ValueError(f"no encoding of {word!r}")
                last = out[-1]
                at -= size[token]
                token = shorter[token]
        return tuple(out[1:])

    def encode_piece(self, word: str) -> bytes:
        mapped = word if word.isascii() and word.isprintable() else "".join(map(self.alphabet.__getitem__, word.encode()))
        return np.array(self.encode_word(mapped), np.int32).tobytes()

    def words(self, text: str) -> list[str]:
        """Pieces of a text without special tokens, normalised and split as the vocabulary's file says."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # lower-casing letter by letter: a final sigma stays an ordinary one
        low = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        return (self.full if self.odd.search(low) else self.plain).findall(low)

    def pieces(self, text: str) -> Iterator[str]:
        """Parts that no merge crosses: special tokens, and what white space separates."""
        for part in self.cut.split(text) if self.cut and "<|" in text else [text]:
            if part in self.special or any(c in part for c in "\x1c\x1d\x1e\x1f"):
                yield part  # these four are white space to str.split, but not to the pattern
            else:
                yield from part.split()

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.seen.__getitem__, self.pieces(text))), np.int32)

    def show(self, ids: np.ndarray) -> str:
        """The ids in decimal, joined by spaces."""
        return " ".join(map(self.decimal.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of tokens, special ones included, joined as a vocabulary without decoder joins them: by spaces."""
        if not len(ids):
            return b""
        size = self.offset[ids + 1] - self.offset[ids]
        end = np.cumsum(size)
        where = np.repeat(self.offset[ids] - end + size, size)
        where += np.arange(end[-1])
        return self.buffer[where[:-1]].tobytes()


def encode(docs: DataFrame, vocab_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, token ids as array<int> and the decoded text, one row per input row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = BacktrackingBPE.load(vocab_path)
        for b in slices(batches, "t"):
            ids = [bpe.encode(t or "") for t in b.column(1).to_pylist()]
            back = [bpe.decode(i).decode() for i in ids]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.string())], ["k", "ids", "decoded"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, ids array<int>, decoded string").withColumnRenamed("k", key)


def digests(docs: DataFrame, vocab_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, n_tokens, and SHA-256 of the ids (decimal, joined by spaces) and of the decoded text, one row per input row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = BacktrackingBPE.load(vocab_path)
        sha = hashlib.sha256
        for b in slices(batches, "t"):
            n, ids_sha, text_sha = [], [], []
            for t in b.column(1).to_pylist():
                ids = bpe.encode(t or "")
                n.append(len(ids))
                ids_sha.append(sha(bpe.show(ids).encode()).hexdigest())
                text_sha.append(sha(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["k", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("k", key)


def lengths(docs: DataFrame, vocab_path: str, text: str = "text") -> DataFrame:
    """All columns but ``text``, plus n_tokens: the encoded length of the whole text."""
    ship(docs.sparkSession)
    rest = [c for c in docs.columns if c.lower() not in (text.lower(), "n_tokens")]
    held = free_name("text", rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = BacktrackingBPE.load(vocab_path)
        for b in slices(batches, held):
            n = pa.array([len(bpe.encode(t or "")) for t in b.column(len(rest)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], n], [*rest, "n_tokens"])

    schema = docs.select(*[F.col(f"`{c}`") for c in rest]).schema.add("n_tokens", "long")
    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias(held)).mapInArrow(run, schema)
