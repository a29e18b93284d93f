"""Whole-text token ids from a tokenizer file, at the speed of a word cache.

The ids are exactly those of ``Tokenizer.encode`` on the whole text. A text of
common characters is cut where the tokenizer itself can never join (at words, or
between runs of letters, digits and signs), each distinct piece is encoded once
per worker, and the ids are put together from the cache; any other text, also one
that holds the string of an added token (which the tokenizer gives its own id),
is encoded whole.
"""
from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters for which Python's and the tokenizer's classes (space, letter, digit) agree.
_COMMON = re.compile(r"[^\t\n\r\x20-\x7e\xc0-\xff]")
#: The pre-tokenizer's own pattern, written for those characters (lower case).
_WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
#: Kinds of bytes in texts of common characters (two bytes of a character above 0x7f are of one kind).
_SPACE, _BLANK, _LETTER, _DIGIT, _SIGN, _QUOTE = range(6)
_KINDS = np.full(256, _SIGN, np.uint8)
_KINDS[[9, 10, 13]], _KINDS[32], _KINDS[ord("'")] = _BLANK, _SPACE, _QUOTE
_KINDS[48:58] = _DIGIT
_KINDS[65:91] = _KINDS[97:123] = _KINDS[128:] = _LETTER
CACHE_ENTRIES = 1_200_000   # pieces kept per worker (about 200 MB); beyond it the cache starts anew


def _cuts(byte_level: bool) -> np.ndarray:
    """By kinds of a byte and the next: is there surely a cut between them? A byte-level tokenizer
    never joins across these; any other one at least not before white space."""
    cut = np.zeros((8, 8), bool)
    cut[_LETTER:, :_LETTER] = True                # before white space
    if byte_level:
        cut[_LETTER:, _LETTER:] = True            # between runs of letters, digits and signs
        for k in range(_LETTER, _SIGN + 1):
            cut[k, k] = False
        cut[_SIGN, _QUOTE] = cut[_QUOTE, _SIGN] = cut[_QUOTE, _QUOTE] = False
        cut[_QUOTE, _LETTER] = False              # 's, 't, 're, ...
    return cut.reshape(-1)


class Encoder:
    """Encodes lists of texts to little-endian id bytes of ``dtype``."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)", re.I)
        self.starts = sorted({t[0] for t in added})
        self.size = max(vocab.values()) + 1
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.word_ends = any(w.endswith("</w>") for w in vocab)
        self.mark = np.zeros(self.size, bool)
        for w, i in vocab.items():
            self.mark[i] = w.endswith("</w>") if self.word_ends else w.startswith("Ġ")
        rules = json.loads(self.tok.to_str())
        before = rules["pre_tokenizer"] or {}
        self.byte_level = rules["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"]
        self.cuts = _cuts(self.byte_level)
        self.cache: dict[str, bytes] = {}
        self.cache_entries = cache_entries

    def _plain(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Add unseen pieces to the cache; those between blanks are put together from the parts that
        the tokenizer itself cuts them into, which are met again more often."""
        if not self.word_ends:
            return self._learn_parts(pieces)
        cut = [[p] if p.isalpha() else _WORDS.findall(p) for p in pieces]
        self._learn_parts(list({w for ws in cut for w in ws}.difference(self.cache)))
        get = self.cache.__getitem__
        self.cache.update([(p, b"".join(map(get, ws))) for p, ws in zip(pieces, cut) if len(ws) != 1 or ws[0] != p])

    def _learn_parts(self, pieces: list[str]) -> None:
        """Encode unseen pieces, many in one string that the marks cut again."""
        if self.word_ends:
            joined, single, glue = pieces, [], " "
        else:
            ok = [len(p) > 1 and p[0] == " " and not p[1].isspace() for p in pieces]
            joined = [p for p, k in zip(pieces, ok) if k]
            single, glue = [p for p, k in zip(pieces, ok) if not k], ""
        for at in range(0, len(joined), 10_000):
            part = joined[at:at + 10_000]
            ids = np.array(self.tok.encode_batch_fast([glue.join(part)], add_special_tokens=False)[0].ids, self.dtype)
            marks = np.flatnonzero(self.mark[ids])
            ends = marks + 1 if self.word_ends else np.append(marks[1:], len(ids))
            if len(ends) != len(part) or (len(ids) and ends[-1] != len(ids)):
                single = single + part
                continue
            raw, w = ids.tobytes(), self.dtype.itemsize
            ends = (ends * w).tolist()
            self.cache.update(zip(part, (raw[a:z] for a, z in zip([0, *ends], ends))))
        self.cache.update(zip(single, self._plain(single)))

    def _odd(self, text: str) -> bool:
        if _COMMON.search(text):
            return True
        return any(c.lower() in text or c.upper() in text for c in self.starts) and bool(self.added.search(text))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        whole = [i for i, t in enumerate(texts) if t and self._odd(t)]
        odd = set(whole)
        cut = [i for i, t in enumerate(texts) if t and i not in odd]
        if len(self.cache) > self.cache_entries:
            self.cache.clear()
        put = self._by_words if self.word_ends else self._by_pieces
        for i, ids in zip(cut, put([texts[i] for i in cut])):
            out[i] = ids
        for i, ids in zip(whole, self._plain([texts[i] for i in whole])):
            out[i] = ids
        return out

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        """Numpy finds the cuts in the texts' bytes, Arrow numbers the pieces between them."""
        raw = [t.encode() for t in texts]
        joined = np.frombuffer(b"".join(raw), np.uint8)
        if not len(joined):
            return [b""] * len(texts)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        kind = _KINDS[joined]
        sign = np.flatnonzero(joined == 0xC3)              # U+00D7 and U+00F7 are no letters
        sign = sign[joined[sign + 1] | 0x20 == 0xB7]
        kind[sign] = kind[sign + 1] = _SIGN
        cut = np.ones(len(joined) + 1, bool)
        cut[1:-1] = self.cuts[kind[:-1] << 3 | kind[1:]]
        cut[ends] = True
        if self.byte_level:     # a space belongs to what follows; a tab or line feed does not, nor to white space before it
            last = np.flatnonzero(kind == _BLANK)
            last = last[~cut[last + 1]]
            last = last[kind[last + 1] >= _LETTER]
            cut[last] = cut[last + 1] = True
        at = np.flatnonzero(cut)
        pieces = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(joined))
        return self._laid_out(pieces, np.append(0, np.searchsorted(at, ends)))

    def _by_words(self, texts: list[str]) -> list[bytes]:
        """Arrow splits at white space; at either end it gives an empty word, which has no ids."""
        if not texts:
            return []
        lists = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.string()))
        return self._laid_out(lists.flatten(), lists.offsets.to_numpy())

    def _laid_out(self, pieces: pa.Array, bounds: np.ndarray) -> list[bytes]:
        """Ids of the texts whose pieces lie between the bounds. Arrow numbers the pieces, so the
        cache is asked once for each distinct one; their ids are laid out by number."""
        coded = pieces.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        got = list(map(self.cache.get, words))
        new = [i for i, x in enumerate(got) if x is None]
        self._learn([words[i] for i in new if words[i]])
        for i in new:
            got[i] = self.cache[words[i]] if words[i] else b""
        ids = np.frombuffer(b"".join(got), self.dtype)
        length = np.fromiter(map(len, got), np.int64, len(got)) // self.dtype.itemsize
        start = np.cumsum(length) - length
        code = coded.indices.to_numpy()
        n = length[code]
        after = np.cumsum(n)
        at = np.repeat(start[code] - (after - n), n)
        at += np.arange(len(at))
        raw = ids[at].tobytes()
        ends = np.append(0, after)[bounds] * self.dtype.itemsize
        return [raw[a:z] for a, z in zip(ends[:-1].tolist(), ends[1:].tolist())]


@functools.lru_cache(maxsize=2)
def encoder(path: str, cache_entries: int = CACHE_ENTRIES) -> Encoder:
    """One encoder per worker process and file; tasks of a reused worker share its cache."""
    return Encoder(path, cache_entries)
