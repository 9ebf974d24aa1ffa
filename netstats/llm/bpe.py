"""Byte-level BPE: exact encoding in linear time by backtracking, decoding by an offset table."""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from netstats.llm.shared import kept_in_worker, pieces_of

#: Fixed value: the pattern by which byte-level tokenizers cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words, and pairs of tokens, that a worker remembers; words of more characters are not.
WORDS, PAIRS, WORD_CHARS = 500_000, 1_000_000, 24
#: A space between two words. No piece reaches across the place before it.
WORD_SPACE = re.compile(r" (?<=[^\s\x1c-\x1f] )(?=[^\s\x1c-\x1f])")
#: Tokens decoded at a time.
BLOCK = 1 << 18


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """Tables of one tokenizer file, whose merged tokens must be numbered in the order of their merges."""

    def __init__(self, content: str) -> None:
        file = json.loads(content)
        model, added = file["model"], file.get("added_tokens", [])
        plain = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}
        before = file["pre_tokenizer"] or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or file.get("normalizer"):
            raise ValueError("not a byte-level BPE tokenizer without normalizer and prefix space")
        if any(t.get(k, v) != v for t in added for k, v in plain.items()):
            raise ValueError("added tokens with options are not supported")
        letters = _byte_letters()
        self.ids = {bytes(letters[c] for c in k): v for k, v in model["vocab"].items()}
        size = max([*self.ids.values(), *(t["id"] for t in added)]) + 1
        self.bytes: list[bytes] = [b""] * size
        for k, v in self.ids.items():
            self.bytes[v] = k
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: list[tuple[int, int] | None] = [None] * size
        last = -1
        for pair in model["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right = (self.ids[bytes(letters[c] for c in x)] for x in (a, b))
            token = self.ids[self.bytes[left] + self.bytes[right]]
            if token <= last:
                raise ValueError("tokens are not numbered in the order of merges")
            self.merged[left, right], self.halves[token], last = token, (left, right), token
        self.first_merged = next((i for i, x in enumerate(self.halves) if x), size)
        self.special = {t["content"]: t["id"] for t in added}
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        for k, v in self.special.items():
            self.bytes[v] = k.encode()
        self.pattern = regex.compile(PATTERN)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[str, bytes]] = {}
        # Tokens that their own bytes do not merge into can never occur.
        self.usable = usable = {k: v for k, v in self.ids.items() if v < self.first_merged or self._whole(v)}
        self.search = ahocorasick.Automaton()
        self.shorter: list[int] = [-1] * size
        for k in usable:
            self.search.add_word(k.decode("latin-1"), (usable[k], len(k) - 1))
            self.shorter[usable[k]] = next((usable[k[:n]] for n in range(len(k) - 1, 0, -1) if k[:n] in usable), -1)
        self.search.make_automaton()
        self.sizes = [len(x) for x in self.bytes]
        self.length = np.array(self.sizes, np.int64)
        self.offset = np.cumsum(self.length) - self.length
        self.blob = np.frombuffer(b"".join(self.bytes), np.uint8)

    def _boundary(self, left: int, right: int, limit: int) -> bool:
        """Whether no merge older than `limit` joins anything across the boundary of two tokens.

        The younger of the two is undone again and again: before it was made, its half next to
        the boundary stood there. A pair across the boundary would have merged if it is older than the merge that ended it.
        Of equal merges the left one comes first.
        """
        while True:
            if self.merged.get((left, right), limit) < limit:
                return False
            if max(left, right) < self.first_merged:
                return True
            if left > right:
                limit, left = left, self.halves[left][1]
            else:
                limit, right = right + 1, self.halves[right][0]

    def _whole(self, token: int) -> bool:
        return self._boundary(*self.halves[token], token)

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both together leaves these two tokens."""
        pair = (left, right)
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[pair] = self._boundary(left, right, len(self.bytes))
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """The tokens of a piece: the longest at each place, shortened or taken back where a pair is not compatible."""
        if (whole := self.usable.get(piece)) is not None:
            return [whole]
        longest = [-1] * len(piece)
        for end, (token, before) in self.search.iter(piece.decode("latin-1")):
            longest[end - before] = token
        size, shorter, compatible = self.sizes, self.shorter, self.compatible
        out: list[int] = []
        at, dead, token = 0, set(), longest[0]
        while at < len(piece):
            while token >= 0:
                end = at + size[token]
                if end not in dead and (not out or compatible(out[-1], token)):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                token = longest[at] if at < len(piece) else -1
            else:
                dead.add(at)
                back = out.pop()
                at -= size[back]
                token = shorter[back]
        return out

    def _ids(self, text: str) -> tuple[str, bytes]:
        if text[:1] == " " and text[1:].isalpha():  # one piece, as most words are
            ids = self.encode_piece(text.encode())
        else:
            ids = [x for p in self.pattern.findall(text) for x in self.encode_piece(p.encode())]
        return ",".join(map(str, ids)), array("i", ids).tobytes()

    def _word(self, word: str) -> tuple[str, bytes]:
        made = self._ids(" " + word)
        if len(word) <= WORD_CHARS:
            if len(self.words) >= WORDS:
                self.words.clear()
            self.words[word] = made
        return made

    def _plain(self, text: str) -> list[tuple[str, bytes]]:
        """Ids of a text without special tokens, cut before each space between words and put together from known words."""
        first, *words = WORD_SPACE.split(text)
        get, make = self.words.get, self._word
        return [self._ids(first)] * bool(first) + [get(w) or make(w) for w in words]

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """Token ids, and the same as decimal text joined by commas. Special tokens in the text are taken as such."""
        found, at = [], 0
        for hit in self.specials.finditer(text):
            token = self.special[hit[0]]
            found += [*self._plain(text[at : hit.start()]), (str(token), np.int32(token).tobytes())]
            at = hit.end()
        found += self._plain(text[at:])
        return np.frombuffer(b"".join([x[1] for x in found]), np.int32), ",".join([x[0] for x in found if x[0]])

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' bytes, gathered from one blob by an offset table, as valid UTF-8."""
        out = []
        for block in (ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK)):
            lengths = self.length[block]
            shift = self.offset[block] - (np.cumsum(lengths) - lengths)
            out.append(self.blob[np.repeat(shift, lengths) + np.arange(lengths.sum())].tobytes())
        return b"".join(out).decode("utf-8", "replace").encode()


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids (array<int>), ids_sha256 and decoded_sha256 for every row of `docs`.

    `tokenizer` is the path of a byte-level tokenizer file on the driver, which is sent to the workers (its size
    does not depend on the data). Whole texts are encoded; null counts as empty and has no tokens. Columns
    that are not used downstream are not sent back: see `token_digests`.
    """
    return _run(docs, tokenizer, with_ids=True)


def token_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """As `encode`, without the ids themselves."""
    return _run(docs, tokenizer, with_ids=False)


def _run(docs: DataFrame, tokenizer: str, with_ids: bool) -> DataFrame:
    with open(tokenizer, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    name = "bpe_" + hashlib.sha256(content.value.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = kept_in_worker(name, lambda: ByteBpe(content.value))
        for batch in pieces_of(batches):
            counts, digests, decoded, tokens = [], [], [], []
            for text in batch.column(1).to_pylist():
                ids, joined = bpe.encode(text or "")
                counts.append(len(ids))
                digests.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                if with_ids:
                    tokens.append(ids)
            columns = [batch.column(0), pa.array(counts, pa.int64())]
            columns += [pa.array(tokens, pa.list_(pa.int32()))] * with_ids
            columns += [pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids
    fields += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    names = [f.name for f in fields]
    return docs.select("doc_id", "text").mapInArrow(run, T.StructType(fields))
