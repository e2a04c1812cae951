"""Token ids of texts, in tasks, with a public tokenizer file."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

# Fixed value: how a tokenizer file says that runs of letters, digits and runs of other characters are encoded apart.
_APART = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Words that a file treats in a way of its own, or whose letters may change when they are composed: anything beyond
# Latin letters, the dotted capital I, and what may be part of a special token.
_OTHER = r"[^\x{00}-\x{24F}]|\x{130}|<\|"
# A letter and what ends its run (not an apostrophe, which may begin an ending of the word).
_END = r"(\p{L})([^\p{L}'])"
_MARK = "\x01"


class Recent:
    """Values by key, of which about the last ``limit`` to twice as many used are kept."""

    def __init__(self, limit: int):
        self._limit, self._new, self._old = limit, {}, {}

    def of(self, keys: set[bytes], make: Callable[[list[bytes]], list[bytes]]) -> dict[bytes, bytes]:
        """A table with all ``keys``; ``make`` gives the values of unknown ones."""
        missing = keys - self._new.keys()
        if len(self._new) + len(missing) > self._limit:
            self._old, self._new, missing = self._new, {}, keys
        old = self._old
        self._new.update((k, old[k]) for k in missing & old.keys())
        unknown = [k for k in missing if k not in old]
        self._new.update(zip(unknown, make(unknown)))
        return self._new


class WordEncoder:
    """Encodes texts with a ``tokenizers`` file that never joins text across white space.

    Texts are cut at ASCII white space and each word is encoded once, then looked up; for a
    tokenizer that drops white space this gives the ids of the whole text. Where the file
    encodes letters, digits and other characters apart, words are cut there too, and lowered
    where it does that, so fewer differ. New parts are encoded many at a time, with a mark
    between them. A table of parts that holds ``known`` entries becomes the older one, from
    which what comes up again is taken over, and a new one is begun; so memory is bounded
    and common parts stay.
    """

    def __init__(self, path: str, plain_specials: bool = False, known: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(path)
        self._model.encode_special_tokens = plain_specials
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        cut = [r.get("pattern", {}).get("Regex", "") for r in (rules["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self._apart = any(c.endswith(_APART) for c in cut)
        self._lower = '"Lowercase"' in json.dumps(rules["normalizer"])
        mark = self._model.encode(f" {_MARK} ", add_special_tokens=False).ids
        self._mark = mark[0] if len(mark) == 1 else None
        self._parts = Recent(known)

    def _encoded(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece; pieces that hold the mark, or a file without one, are encoded one by one."""
        import numpy as np

        if self._mark is not None and b"\x01" not in b"".join(pieces):
            text = f" {_MARK} ".join(p.decode() for p in pieces)
            ids = np.asarray(self._model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            at = np.flatnonzero(ids == self._mark)
            if len(at) == len(pieces) - 1:
                raw, ends = ids.tobytes(), [*(4 * at).tolist(), 4 * len(ids)]
                return [raw[a:b] for a, b in zip([0, *(4 * at + 4).tolist()], ends)]
        found = self._model.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in found]

    def _cut(self, words):
        """Words (an Arrow array) with spaces where the file cuts them anyway."""
        import pyarrow.compute as pc

        cut = pc.utf8_lower(words) if self._lower else words
        if self._apart:
            cut = pc.replace_substring_regex(cut, r"[0-9]", r" \0 ")
            cut = pc.replace_substring_regex(cut, _END, r"\1 \2")
        return pc.if_else(pc.match_substring_regex(words, _OTHER), words, cut)

    def _encode_parts(self, parts: list[bytes]) -> list[bytes]:
        return [ids for some in batches(parts, len, 20_000) for ids in self._encoded(some)]

    def encode(self, texts) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text (a list or an Arrow array); a null text has none.

        Arrow cuts the texts and names their different words, so Python sees each word of a batch once.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = (pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())).fill_null("")
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        parts = pc.ascii_split_whitespace(self._cut(coded.dictionary))
        named = parts.flatten().dictionary_encode()
        different = named.dictionary.cast(pa.large_binary()).to_pylist()
        known = self._parts.of(set(different) - {b""}, self._encode_parts)
        made = pa.array([known[p] if p else b"" for p in different], pa.large_binary()).take(named.indices)
        if not len(made):
            return [b""] * len(texts)
        _, ends, data = made.buffers()
        # A word's ids are those of its parts, a text's those of its words, one behind the other.
        ends = np.frombuffer(ends, dtype=np.int64)[np.asarray(parts.offsets)]
        of_words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(parts), [None, pa.py_buffer(ends), data])
        made = of_words.take(coded.indices)
        _, ends, data = made.buffers()
        at = np.frombuffer(ends, dtype=np.int64)[np.asarray(words.offsets)]
        raw = memoryview(data) if data is not None else memoryview(b"")
        return [raw[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def tokenizer_path(path: str | None, name: str = "word_bpe_49k.json") -> str:
    """``path``, or the place of the installed public file of that name."""
    if path is not None:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(batch, column: str, limit: int = 8_000_000):
    """Consecutive slices of a record batch whose texts sum to about ``limit`` bytes; a longer text is alone at most."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    turn = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def batches(values: list, weight, limit: int = 4_000_000):
    """Consecutive lists whose weights sum to about ``limit``, so long texts do not pile up."""
    part, total = [], 0
    for v in values:
        part.append(v)
        total += weight(v)
        if total >= limit:
            yield part
            part, total = [], 0
    if part:
        yield part
