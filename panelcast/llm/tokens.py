"""Token ids of whole texts by the ``tokenizers`` library, one encoding per distinct word.

Both vocabularies split a text before they merge, and never join what a space or line feed
separates. So a text is cut before every single space or line feed that stands between other
characters, and a piece is encoded once and remembered. A byte-level vocabulary lets a run of white
space depend on all of it; texts with such runs, or with other white space, are encoded whole.
"""

from __future__ import annotations

import json
import os
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a worker remembers in each of two generations (about 300 MB together); what a
#: generation has not used when the next one is full is forgotten.
REMEMBERED = 700_000
#: New pieces that are encoded as one text.
JOINED = 1000
#: White space other than single spaces and line feeds, and the mark of a text's first piece.
_WHOLE = r"[ \n][ \n]|[\x01\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_FIRST = "\x01"


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if self.vocabulary <= 1 << 16 else np.dtype("<u4")
        self.begins = self._beginnings()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _beginnings(self) -> np.ndarray | None:
        """Whether an id begins with a space or line feed, for plain byte-level vocabularies (else None).

        Their tokens spell the bytes of the text, and none reaches over a space: each one that begins with it is a piece's first.
        """
        parts = json.loads(self.tokenizer.to_str())
        steps = parts.get("pre_tokenizer") or {}
        kinds = [step.get("type") for step in steps.get("pretokenizers", [steps])]
        prefixed = any(step.get("add_prefix_space") for step in steps.get("pretokenizers", [steps]))
        added = any(t.get("lstrip") or t.get("rstrip") or set(t["content"]) & set(" \n") for t in parts.get("added_tokens") or [])
        if kinds != ["ByteLevel"] or prefixed or added or parts.get("normalizer"):
            return None
        out = np.zeros(self.vocabulary, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            out[i] = token[:1] in ("\u0120", "\u010a")
        return out

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.dtype.char, e.ids).tobytes() for e in found]

    def _learn(self, pieces: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        again = {p: v for p in pieces if (v := self.older.get(p)) is not None}
        self.known.update(again)
        new = [p for p in pieces if p not in again]
        # a piece stands for itself with the space or line feed before it; a first piece has none
        as_text = [p[1:] if p[0] == _FIRST else p if p[0] == "\n" else " " + p for p in new]
        alone = [i for i, t in enumerate(as_text) if len(t) <= 1 or t[0] not in " \n"]
        self.known.update(zip([new[i] for i in alone], self._whole([as_text[i] for i in alone])))
        for i in reversed(alone):
            del new[i], as_text[i]
        for at in range(0, len(new), JOINED):
            self.known.update(zip(new[at:at + JOINED], self._joined(as_text[at:at + JOINED])))

    def _joined(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that each begin with a space or line feed, from one encoding cut where they begin or end."""
        if self.begins is not None:
            raw = self._whole(["".join(texts)])[0]
            first = np.flatnonzero(self.begins[np.frombuffer(raw, self.dtype)])
            if len(first) != len(texts):
                return self._whole(texts)
            cut = [*(first * self.dtype.itemsize).tolist(), len(raw)]
            return [raw[a:b] for a, b in zip(cut, cut[1:])]
        whole = self.tokenizer.encode("".join(texts), add_special_tokens=False)
        ends = np.cumsum([len(t) for t in texts])
        last = np.array([b for _, b in whole.offsets], np.int64)
        cut = np.concatenate([[0], np.searchsorted(last, ends, side="right")]) * self.dtype.itemsize
        raw = array(self.dtype.char, whole.ids).tobytes()
        if (np.diff(last) < 0).any() or cut[-1] != len(raw):  # offsets that do not follow the text
            return self._whole(texts)
        return [raw[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        whole = pc.match_substring_regex(pa.array(texts, pa.large_string()), _WHOLE).to_pylist()
        pieces = [None if w else (_FIRST + t.replace("\n", " \n")).split(" ") for t, w in zip(texts, whole)]
        flat = list(chain.from_iterable(p for p in pieces if p is not None))
        # a last space leaves an empty piece, which stands for that space
        found = list(map(self.known.get, flat)) if "" not in flat else [self._one(p) for p in flat]
        missing = [i for i, v in enumerate(found) if v is None]
        if missing:
            self._learn({flat[i] for i in missing})
            for i in missing:
                found[i] = self.known[flat[i]]
        out, at = [], 0
        for text, some in zip(texts, pieces):
            if some is None:
                raw = self._whole([text])[0]
            else:
                raw = b"".join(found[at:at + len(some)])
                at += len(some)
            out.append(np.frombuffer(raw, self.dtype))
        return out

    def _one(self, piece: str) -> bytes | None:
        return self._whole([" "])[0] if piece == "" else self.known.get(piece)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
