"""BPE encoding and decoding by batched numpy merge rounds.

The symbols of many distinct words lie in one flat array. In every round each word finds its
lowest-ranked adjacent pair (by binary search over the sorted pair keys of the merge table) and all
its occurrences are merged left to right; only pairs next to a merge are looked up again. Words
that have no pair left leave the array, so a round costs what is still open.

The tokenizer file (a BPE model with NFC, white-space and lower-case normalisation and a split
pattern, byte-level symbols and a word-end suffix) is read by path on the executors; its path is a
parameter. Whole texts are encoded in one pass without a shuffle.

Defined cases: a null text is encoded as empty (no ids, decoded text ""); special tokens that occur
in a text become their ids, as with the tokenizers library's default; null or repeated ids and
repeated rows give one row each; only the id and text columns are read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tessella.llm.common import in_batches, release_memory, slices

#: Characters of the Unicode property White_Space.
SPACE = "\t-\r \x85\xa0  -     　"
CHUNK = re.compile(f"[^{SPACE}]+")
#: The tokenizer's own split pattern, with white space spelled out and letters and numbers as parameters.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^" + SPACE + r"{letter}{number}]+"
SUFFIX = "</w>"
#: The chunk cache is emptied beyond so many bytes of chunks and ids; an entry counts for its objects too.
CACHE_BYTES = 12 * 2**20
#: Texts are encoded in slices of about so many bytes; their chunks take about 20 times as much while they are.
SLICE_BYTES = 2**19
ENTRY_BYTES = 150
#: Chunks below this character are split by a short pattern.
PLAIN_END = "\u0180"
NONE = np.int64(2**62)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def recent_characters(spec: dict) -> tuple[set[str], dict[int, str]]:
    """(letters and numbers the library does not know, lower case of others).

    Unicode tables differ by release. Characters that this Python has no category for are looked up
    in the tokenizers library, once for a file and worker; the others are the same in both. The library gets
    the file without its vocabulary, which takes 40 MB there and has no part in this.
    """
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(json.dumps(spec | {"added_tokens": [], "model": spec["model"] | {"vocab": {}, "merges": []}}))
    split, lower = library.pre_tokenizer.pre_tokenize_str, library.normalizer.normalize_str
    doubtful = [c for c in characters(r"[\p{L}\p{N}]") if unicodedata.category(c) == "Cn"]
    unknown = {c for c in doubtful if len(split(c + "a")) == 2 and len(split(c + "!")) == 1}
    return unknown, {ord(c): low for c in doubtful if (low := lower(c)) != c}


def characters(kind: str) -> str:
    """All characters of a regex class in ascending order, looked for in blocks: held one by one, all there are take over 100 MB."""
    found = regex.compile(kind)
    blocks = ("".join(map(chr, range(a, a + 0x800))) for a in range(0, 0x110000, 0x800) if a != 0xD800)  # that one is the surrogates
    return "".join("".join(found.findall(b)) for b in blocks)


def piece_pattern(unknown: set[str]) -> regex.Pattern:
    """The split pattern; letters and numbers without the unknown ones."""
    if not unknown:
        return regex.compile(PIECE.format(letter=r"\p{L}", number=r"\p{N}"))
    known = lambda kind: ranges("".join(c for c in characters(rf"[\p{{{kind}}}]") if c not in unknown))
    return regex.compile(PIECE.format(letter=known("L"), number=known("N")))


def plain_pattern(unknown: set[str]) -> re.Pattern:
    """The split pattern for texts of characters below ``PLAIN_END``: the same pieces by short classes, at a fraction of the time."""
    plain = "".join(c for c in map(chr, range(ord(PLAIN_END))) if c not in unknown)
    return re.compile(PIECE.format(letter=ranges("".join(regex.findall(r"\p{L}", plain))), number=ranges("".join(regex.findall(r"\p{N}", plain)))))


def ranges(chars: str) -> str:
    """Sorted characters as the inside of a regex class."""
    codes = np.array([ord(c) for c in chars])
    cut = np.flatnonzero(np.diff(codes) != 1) + 1
    return "".join(f"{chr(r[0])}-{chr(r[-1])}" for r in np.split(codes, cut))


def lowered(text: str, recent: dict[int, str]) -> str:
    """NFC, then lower case character by character (no final-sigma rule)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).translate(recent).replace("Σ", "σ").lower()


class Bpe:
    """A tokenizer file's tables as sorted numpy arrays, with a bounded cache of chunks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = np.empty(size, dtype=object)
        for token, i in itertools.chain(vocab.items(), self.special.items()):
            self.tokens[i] = token.encode()
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.last = np.array([vocab[s + SUFFIX] for s in symbols], dtype=np.int64)
        self.size = size
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = left * size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        # Merging every occurrence of a pair at once equals one by one if what a merge makes is only used by later merges.
        rank = np.arange(len(pairs))
        first_use = np.full(size, NONE)
        np.minimum.at(first_use, left, rank)
        np.minimum.at(first_use, right, rank)
        self.together = bool((first_use[made] > rank).all())
        self.by_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        unknown, self.recent = recent_characters(spec)
        self.piece, self.plain = piece_pattern(unknown), plain_pattern(unknown)
        self.cache: dict[str, bytes] = {}
        self.cached = 0

    def _look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of each pair; NONE where there is no merge."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return np.where(hit, self.ranks[at], NONE), self.made[at]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian, 32 bits) of each non-empty word by merge rounds over all words at once."""
        lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        sym, ends = self.inner[flat], np.cumsum(lens) - 1
        sym[ends] = self.last[flat[ends]]
        word = np.repeat(np.arange(len(words)), lens)
        rank, made = np.full(len(sym), NONE), np.zeros(len(sym), dtype=np.int64)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside], made[inside] = self._look_up(sym[inside], sym[inside + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            counts = np.diff(np.r_[starts, len(sym)])
            best = np.repeat(np.minimum.reduceat(rank, starts), counts)
            closed = best == NONE
            if closed.any():
                done.append((word[closed], sym[closed]))
                sym, word, rank, made, best = (x[~closed] for x in (sym, word, rank, made, best))
                if not len(sym):
                    break
            chosen = rank == best
            places = np.flatnonzero(chosen)
            if self.together:  # of pairs that overlap (aaa) every second one, from the left
                run = np.r_[True, np.diff(places) != 1]
                begin = np.maximum.accumulate(np.where(run, np.arange(len(places)), 0))
                places = places[(np.arange(len(places)) - begin) % 2 == 0]
            else:
                places = places[np.r_[True, word[places][1:] != word[places][:-1]]]
            sym[places] = made[places]
            keep = np.ones(len(sym), dtype=bool)
            keep[places + 1] = False
            now = places - np.arange(len(places))
            sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
            again = np.r_[now, now[now > 0] - 1]
            rank[again] = NONE
            again = again[again < len(sym) - 1]
            again = again[word[again] == word[again + 1]]
            rank[again], made[again] = self._look_up(sym[again], sym[again + 1])
        which, ids = (np.concatenate(x) for x in zip(*done))
        raw = ids[np.argsort(which, kind="stable")].astype("<u4").tobytes()
        ends = (np.cumsum(np.bincount(which, minlength=len(words))) * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def pieces(self, chunk: str) -> list[bytes]:
        """What a chunk without white space splits into, normalised."""
        low = lowered(chunk, self.recent)
        if low.isascii() and low.isalpha():
            return [low.encode()]
        pattern = self.plain if low.isascii() or max(low) < PLAIN_END else self.piece
        return [p.encode() for p in pattern.findall(low)]

    def _learn(self, chunks: set[str]) -> None:
        """Put chunks without white space or special tokens into the cache."""
        split = {c: self.pieces(c) for c in chunks}
        pieces = list({p for ps in split.values() for p in ps})
        known: dict[bytes, bytes] = {}
        for i in range(0, len(pieces), 50_000):
            part = pieces[i : i + 50_000]
            known.update(zip(part, self.merge(part)))
        for c, ps in split.items():
            ids = self.cache[c] = b"".join(map(known.__getitem__, ps))
            self.cached += ENTRY_BYTES + len(c) + len(ids)

    def _parts(self, text: str) -> list[str]:
        """Chunks of a text and the special tokens in it (kept in the cache as chunks of their own)."""
        if self.by_special is None or not any(s in text for s in self.special):
            return CHUNK.findall(text)
        out: list[str] = []
        for part in self.by_special.split(text):
            out.extend([part] if part in self.special else CHUNK.findall(part))
        return out

    def encode_slice(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not self.cache or self.cached > CACHE_BYTES:
            self.cache, self.cached = {s: i.to_bytes(4, "little") for s, i in self.special.items()}, 0
        parts = [self._parts(t) for t in texts]
        new = set()
        for p in parts:
            new.update(p)
        new.difference_update(self.cache)
        if new:
            self._learn(new)
        get = self.cache.__getitem__
        return [b"".join(map(get, p)) for p in parts]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text: the tokens joined by one space, special ones kept."""
        return b" ".join(self.tokens[ids].tolist())


@functools.lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """The tables of a tokenizer file, once per Python worker."""
    loaded = Bpe(path)
    release_memory()  # reading the file takes several times what is kept
    return loaded


def encoded_texts(texts: list[str | None], path: str) -> list[bytes]:
    """Ids of each text (nulls are empty) as little-endian bytes."""
    return load(path).encode_slice([t or "" for t in texts])


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids`` (array of int) of every text."""

    def run(batches):
        for batch in slices(batches, 1, SLICE_BYTES):
            raw = encoded_texts(batch.column(1).to_pylist(), path)
            ends = np.cumsum([0, *map(len, raw)], dtype=np.int64) // 4
            values = np.frombuffer(b"".join(raw), dtype="<i4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends.astype(np.int32), values)], names=["id", "ids"])

    kind = docs.select(docs[id_col].alias("id")).schema["id"].dataType.simpleString()
    return in_batches(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))).mapInArrow(run, f"id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``id, text`` of every array of ids; null ids decode to the empty text."""

    def run(batches):
        for batch in batches:
            bpe, lists = load(path), batch.column(1)
            ends = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())].tolist()
            ids = lists.flatten().to_numpy()  # null lists hold none
            out = [bpe.decode(ids[a:b]).decode() for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["id", "text"])

    kind = encoded.select(encoded[id_col].alias("id")).schema["id"].dataType.simpleString()
    return in_batches(encoded.select(encoded[id_col].alias("id"), encoded[ids_col].alias("ids"))).mapInArrow(run, f"id {kind}, text string")


def bpe_digest(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of ids and digests of the ids and of the text decoded from them."""

    def run(batches):
        for batch in slices(batches, 1, SLICE_BYTES):
            bpe, n, of_ids, of_text = load(path), [], [], []
            for raw in encoded_texts(batch.column(1).to_pylist(), path):
                n.append(len(raw) // 4)
                of_ids.append(hashlib.sha256(raw).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(np.frombuffer(raw, dtype="<u4"))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return in_batches(docs.select("doc_id", "text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
