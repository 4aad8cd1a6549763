"""Texts to token ids with a public tokenizer, a chunk of text at a time.

Words repeat far more often than texts do, so ids are kept by chunk.  A chunk
is a stretch between places where the tokenizer's own pre-tokenizer always
cuts, so the ids of a text are the chunks' ids one after the other (tested
against encoding whole texts).  New chunks are encoded many at a time as one
text, cut again where a token starts with the white space before a chunk, or at a
digit put between chunks that have none.  Arrow cuts texts, finds the distinct
chunks and lines up their ids; only texts with white space in a row are cut in
Python.  The store has two generations of about
``MOST_CHUNKS`` entries (``MOST_WORDS``, where white space is dropped), the older of which goes when the younger is full; it
only saves time.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

MOST_CHUNKS, MOST_WORDS = 300_000, 700_000
#: Longer chunks are encoded but not kept.
LONGEST_KEPT = 64
#: Chunks encoded as one text.
TOGETHER = 512
#: Stands between words that do not hold it.
MARK = "0"
_ODD_SPACE = re.compile(r" (?!\S)")
_INNER_SPACE = re.compile(r" (?=\S)")


def tokenizer_path(name: str) -> str:
    return public_tokenizers.path(name)


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian bytes of
    ``dtype``, the narrowest of 16 and 32 bits that holds the vocabulary."""

    _open: dict[str, Encoder] = {}

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        before = made.get("pre_tokenizer") or {}
        # byte-level: a space belongs to the word after it; word-level: white space is dropped
        self.spaced = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        self.words = any(x.get("behavior") == "Removed" and "\\s" in str(x.get("pattern")) for x in before.get("pretokenizers", []))
        self.lower = any(x.get("type") == "Lowercase" for x in (made.get("normalizer") or {}).get("normalizers", [])) and not any(
            t["content"].lower() != t["content"] for t in made.get("added_tokens", []))
        self.added = [t["content"] for t in made.get("added_tokens", [])]
        vocab = self.tokenizer.get_vocab()
        self.starts = np.zeros(max(vocab.values(), default=0) + 1, bool)
        if self.spaced:
            self.starts[[i for x, i in vocab.items() if x.startswith(("\u0120", "\u010a"))]] = True  # the signs of a space and a line break at byte level
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if self.words and len(mark) == 1 and MARK in self.tokenizer.id_to_token(mark[0]) else None
        # first chunks and later ones; what an older store had moves over when it is seen again
        self.young: list[dict[str, bytes]] = [{}, {}]
        self.old: list[dict[str, bytes]] = [{}, {}]
        self.long: list[tuple[int, str]] = []

    @classmethod
    def at(cls, path: str) -> Encoder:
        """One for each Python worker."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _chunks(self, text: str) -> tuple[str, list[str]]:
        if self.words:
            text = text.replace("\n", " ")
            # the tokenizer lower-cases anyway; outside ASCII its rules are not Python's
            return "", (text.lower() if self.lower and text.isascii() else text).split(" ")
        if self.spaced:
            parts = _INNER_SPACE.split(text) if _ODD_SPACE.search(text) else text.split(" ")
            return parts[0], parts[1:]
        return text, []

    def _learn(self, kind: int, chunks: set[str], prefix: str) -> None:
        if len(self.young[kind]) > (MOST_WORDS if self.words else MOST_CHUNKS):
            self.young[kind], self.old[kind] = {}, self.young[kind]
        young, old = self.young[kind], self.old[kind]
        split, new = [], set()
        for x in chunks:
            if (ids := old.get(x)) is not None:
                young[x] = ids
            elif x[-1:] in (",", ".") and x[-2:-1].isalpha() and x[-2] < "\u0250":
                split.append(x)  # a letter and a stop are never one token
                if x[:-1] not in young:
                    new.add(x[:-1])
            else:
                new.add(x)
        for x in [x for x in new if x in old]:
            young[x] = old[x]
            new.discard(x)
        self._encode(kind, list(new), prefix)
        stops = {c: self._ids(c) for c in ",."} if split else {}
        for x in split:
            young[x] = young[x[:-1]] + stops[x[-1]]
            if len(x) > LONGEST_KEPT:
                self.long.append((kind, x))

    def _ids(self, text: str) -> bytes:
        return array(self.dtype.char, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _encode(self, kind: int, new: list[str], prefix: str) -> None:
        young = self.young[kind]
        if kind and self.spaced:
            plain = [x for x in new if (y := x[1:] if x[:1] == "\n" else x) and "\n" not in y and " " not in y and y.strip() == y]
        else:
            plain = [x for x in new if x and MARK not in x] if kind and self.mark is not None else []
        for i in range(0, len(plain), TOGETHER):
            young.update(self._together(plain[i:i + TOGETHER], prefix))
        alone = [x for x in new if x not in young]
        for x, e in zip(alone, self.tokenizer.encode_batch_fast([self._whole(x, prefix) for x in alone], add_special_tokens=False)):
            young[x] = array(self.dtype.char, e.ids).tobytes()
        self.long += [(kind, x) for x in new if len(x) > LONGEST_KEPT]

    def _together(self, chunks: list[str], prefix: str) -> dict[str, bytes]:
        """The ids of chunks encoded as one text; nothing if it can't be cut again."""
        text = "".join([self._whole(x, prefix) for x in chunks]) if self.spaced else f" {MARK} ".join(chunks)
        if any(t in text for t in self.added):
            return {}
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
        if self.spaced:
            first = np.flatnonzero(self.starts[ids])
            last = np.append(first[1:], len(ids))
        else:
            at = np.flatnonzero(ids == self.mark)
            first, last = np.append(0, at + 1), np.append(at, len(ids))
        if len(first) != len(chunks) or first[0]:
            return {}
        data, size = ids.tobytes(), self.dtype.itemsize
        return {x: data[a:b] for x, a, b in zip(chunks, (first * size).tolist(), (last * size).tolist())}

    def _joined(self, kind: int, lists: list[list[str]], prefix: str) -> list[bytes]:
        chunks = set().union(*lists)
        new = chunks.difference(self.young[kind])
        if new:
            self._learn(kind, new, prefix)
        young, old = self.young[kind], self.old[kind]
        here = {x: young[x] if x in young else old[x] for x in chunks}
        return [b"".join(map(here.__getitem__, r)) for r in lists]

    @staticmethod
    def _whole(chunk: str, prefix: str) -> str:
        """A chunk with the space before it, unless a line break is there."""
        return chunk if not chunk or chunk[0] == "\n" else prefix + chunk

    def encode(self, texts: list[str]) -> list[bytes]:
        if not (self.words or self.spaced):
            return self._listed(texts)
        if self.words:
            plain = pa.array(texts, pa.large_string())
            plain = pc.replace_substring(plain, "\n", " ")
            if self.lower:  # as in _chunks
                plain = pc.if_else(pc.string_is_ascii(plain), pc.ascii_lower(plain), plain)
            return self._split(plain, "", 0)
        # white space in a row may be one token: only a single break or space is cut at
        odd = [i for i, t in enumerate(texts) if "\n\n" in t or t[:1].isspace() or _ODD_SPACE.search(t)]
        if not odd:
            return self._broken(texts)
        rest = sorted(set(range(len(texts))).difference(odd))
        out = dict(zip(odd, self._listed([texts[i] for i in odd]))) | dict(zip(rest, self._broken([texts[i] for i in rest])))
        return [out[i] for i in range(len(texts))]

    def _broken(self, texts: list[str]) -> list[bytes]:
        """Of texts cut before every space and line break; a break put before a text is taken off again."""
        plain = pc.replace_substring(pa.array(["\n" + t for t in texts], pa.large_string()), "\n", " \n")
        return self._split(plain, " ", len(self._ids("\n")))

    def _split(self, plain: pa.Array, prefix: str, skip: int) -> list[bytes]:
        lists = pc.split_pattern(plain, " ")
        coded = lists.flatten().dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        new = {x for x in chunks if x not in self.young[1]}
        if new:
            self._learn(1, new, prefix)
        young, old = self.young[1], self.old[1]
        ids = pa.array([young[x] if x in young else old[x] for x in chunks], pa.large_binary()).take(coded.indices)
        self._forget()
        if not len(ids):
            return [b""] * len(plain)
        cuts = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:ids.offset + len(ids) + 1][np.asarray(lists.offsets) - lists.offsets[0].as_py()]
        data = ids.buffers()[2].to_pybytes() if ids.buffers()[2] else b""
        return [data[a + skip:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _forget(self) -> None:
        for kind, x in self.long:
            self.young[kind].pop(x, None)
        self.long.clear()

    def _listed(self, texts: list[str]) -> list[bytes]:
        cut = [self._chunks(t) for t in texts]
        head = self._joined(0, [[h] for h, _ in cut], "")
        rest = self._joined(1, [r for _, r in cut], " " if self.spaced else "")
        self._forget()
        return [a + b for a, b in zip(head, rest)]
