"""Token ids of whole texts by the ``tokenizers`` library.

A byte-level BPE cuts a text before its merges, and one of the cuts always
falls before a single space between two characters that are not white
space. Texts made only of ASCII, Latin letters, single spaces and single
line ends are therefore encoded part by part, and each distinct part once
per worker (the memo); every other text is encoded whole. Both give the
same ids.
"""

from __future__ import annotations

import os
import re

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402

from .common import memo, use_memos  # noqa: E402

MEMO_PARTS = 700_000
CHUNK_CHARS = 1_500_000
JOINED = 64

_OTHER = re.compile("[^!-~¡-ɏ \n]")
_LOADED: dict[str, "Encoder"] = memo("encoders", {})


def _plain(text: str) -> bool:
    return not (text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text
                or "\n " in text or "\n\n" in text or _OTHER.search(text))


def _spell(part: str) -> str:
    """The text of a part: the first part of a text is marked and a part after
    a line end starts with it (its id is put back later); any other follows a
    space."""
    return part[1:] if part[0] in "\x01\n" else " " + part


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.memo: dict[str, bytes] = memo(f"tokens {path}", {})
        self.line = np.array(self.tok.encode("\n", add_special_tokens=False).ids, "<u4")

    def _raw(self, texts: list[str]) -> list[bytes]:
        got = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Ids of parts. A line end is a token of its own between two parts, so
        many parts are encoded as one text and cut at its id."""
        lots = [parts[k:k + JOINED] for k in range(0, len(parts), JOINED)]
        got = self.tok.encode_batch_fast(["\n".join(map(_spell, x)) for x in lots], add_special_tokens=False)
        out: list[bytes] = []
        for lot, e in zip(lots, got):
            ids = np.array(e.ids, "<u4")
            cut = np.flatnonzero(ids == self.line[0])
            if len(cut) != len(lot) - 1:
                out += self._raw([_spell(p) for p in lot])
                continue
            raw = ids.tobytes()
            edge = [-4, *(4 * cut).tolist(), len(raw)]
            out += [raw[a + 4:z] for a, z in zip(edge, edge[1:])]
        end = self.line.tobytes()
        return [end + x if p[0] == "\n" else x for p, x in zip(parts, out)]

    def _some(self, texts: list[str | None]) -> list[bytes]:
        memo = self.memo
        find = memo.get
        parts: list[list[str] | None] = []
        found: list[list[bytes | None]] = []
        holes: list[list[int]] = []
        whole: list[int] = []
        total, miss = 0, set()
        for i, t in enumerate(texts):
            p, ids, hole = None, [], []
            if t and _plain(t):
                p = t.replace("\n", " \n").split(" ")
                p[0] = "\x01" + p[0]
                ids = list(map(find, p))
                total += len(p)
                if None in ids:
                    hole = [k for k, x in enumerate(ids) if x is None]
                    miss.update([p[k] for k in hole])
            elif t:
                whole.append(i)
            parts.append(p)
            found.append(ids)
            holes.append(hole)
        new = dict(zip(miss, self._parts(list(miss)))) if miss else {}
        for p, ids, hole in zip(parts, found, holes):
            for k in hole:
                ids[k] = new[p[k]]
        out = [b"".join(ids) for ids in found]
        if len(memo) >= MEMO_PARTS and sum(map(len, holes)) > 0.4 * total:
            memo.clear()  # other texts than those it was filled with
        if len(memo) < MEMO_PARTS:  # keeps what it learns first, which holds the frequent parts
            memo.update(new)
        if whole:
            for i, ids in zip(whole, self._raw([texts[i] for i in whole])):
                out[i] = ids
        return out

    def encode(self, texts: list[str | None]):
        """Yield the ids of each text, as little-endian unsigned 32-bit bytes,
        in order; works on about a million characters at a time."""
        lot: list[str | None] = []
        size = 0
        for t in texts:
            lot.append(t)
            size += len(t) if t else 0
            if size >= CHUNK_CHARS:
                yield from self._some(lot)
                lot, size = [], 0
        if lot:
            yield from self._some(lot)


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary; the memos of other operators are emptied."""
    use_memos("encoders", f"tokens {path}")
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
