"""Token ids by the tokenizers library, with bounded caches of the ids of recurring units.

A text is cut into units that its tokenizer never merges across: for a vocabulary with word ends the
parts between spaces and line feeds, for byte-level BPE a word with the space or line feed before it,
or, where white space stands together, a run of non-space characters or of white space; a punctuation
mark after an ASCII letter, at a unit's end, is a unit of its own. Equal units have equal ids, so each is
encoded once while it stays in the pool, which looks up the units of a whole batch by hashes in numpy.
Units of ASCII letters go to the library's model alone, since normalising and splitting leave them as they
are. Texts with characters whose class differs between the two pattern libraries are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import string
from collections.abc import Callable, Iterable
from functools import cache

import numpy as np

from terrafold.llm.shingles import mixed

#: Units in each of the two generations of a worker's cache: a full one replaces the older one.
MOST_UNITS = 50_000
#: Units of a worker's pool, which is emptied when it has more; bytes of a batch that is looked up at once.
MOST_POOLED, MOST_BYTES = 1_500_000, 1 << 20
LONGEST_UNIT = 48
#: Units encoded in one call.
AT_ONCE = 1024

#: A word of letters before a full stop or comma, then any run of non-space, then white space.
_UNITS = re.compile(r" ?[^\W\d_]+(?=[.,](?:\s|$))| ?\S+|\s+(?!\S)|\s+")
#: Between units that are encoded in one call, by kind of vocabulary; always tokens of their own.
_BETWEEN = {True: (" \x01 ", "\x01"), False: ("\n", "\n")}
_ODD = re.compile("[\x1c-\x1f\x85]")
_TOGETHER = re.compile(r"\s\s|\s\Z")
#: White space other than spaces and line feeds; without any, looking for two together needs no pattern.
_RARE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPACE, _DOUBLE = frozenset((" ", "\n")), ("  ", " \n", "\n ", "\n\n")
#: Latin letters, whose class and composed form are alike in both libraries; such a unit is one word to the model.
_LATIN = "[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af]+"


def _visible() -> dict[int, str]:
    """The characters that byte-level vocabularies write for bytes: printable ones stand for themselves, the others from U+0100 on."""
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    hidden = sorted(set(range(256)) - set(shown))
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


_VISIBLE = _visible()

#: Characters that end a unit's letters.
_PUNCTUATION = frozenset(string.punctuation)
_IS_MARK, _IS_LETTER = (np.isin(np.arange(256), list(x.encode())) for x in (string.punctuation, string.ascii_letters))

Encode = Callable[[list[str]], Iterable[bytes]]


class Units:
    """Ids of units, kept in two generations; encode gives those of units, encode_after those of what follows a letter."""

    def __init__(self, encode: Encode, encode_after: Encode) -> None:
        self.encode, self.encode_after = encode, encode_after
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def of(self, cuts: list[list[str]]) -> list[bytes]:
        """The joined ids of the units of each cut."""
        get = self.young.get
        found = [list(map(get, cut)) for cut in cuts]
        fresh: set[str] = set()
        for cut, ids in zip(cuts, found, strict=True):
            if None in ids:
                fresh.update([u for u, x in zip(cut, ids, strict=True) if x is None])
        made = self._made(fresh)
        return [b"".join(ids if None not in ids else [made[u] if x is None else x for u, x in zip(cut, ids, strict=True)])
                for cut, ids in zip(cuts, found, strict=True)]

    def made(self, units: list[str]) -> list[bytes]:
        """The ids of distinct units."""
        return list(map(self._made(set(units)).__getitem__, units))

    def _made(self, fresh: set[str]) -> dict[str, bytes]:
        """Ids of units that the young generation does not have; it has them from then on, unless they are long."""
        if len(self.young) > MOST_UNITS:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        made = {u: old[u] for u in fresh if u in old}
        rest = fresh.difference(made)
        ends = {u: s for u in rest if u[-1:] in _PUNCTUATION and (s := u.rstrip(string.punctuation))[-1:].lower().isalpha()}
        plain = rest.difference(ends)
        stems = set(ends.values()).difference(plain)
        known = {s: x for s in stems if (x := young.get(s) or old.get(s))}
        new = [*plain, *stems.difference(known)]
        made.update(zip(new, self.encode(new), strict=True))
        tails = list({u[len(s) :] for u, s in ends.items()})
        after = dict(zip(tails, self.encode_after(tails), strict=True))
        made.update([(u, (known.get(s) or made[s]) + after[u[len(s) :]]) for u, s in ends.items()])
        young.update([(u, x) for u, x in made.items() if len(u) <= LONGEST_UNIT])
        return made


def _grown(held: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
    """The first n of held and then more, with room for as many again where it has to be moved."""
    if n + len(more) > len(held):
        held = np.concatenate([held[:n], np.zeros(n + 2 * len(more), held.dtype)])
    held[n : n + len(more)] = more
    return held


class Pool:
    """Ids of the units of whole batches, looked up by two 64-bit hashes of a unit's bytes in sorted arrays.

    A dictionary of strings costs a main-memory access or more for every word; here a batch is hashed, and
    its distinct units are searched, in a few passes of numpy. Two units would have to agree on 128 bits of
    hash to be taken for each other.
    """

    def __init__(self, encode: Callable[[list[str], list[bool]], list[bytes]]) -> None:
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        # By slot, and the ids themselves; with room to grow.
        self.n, self.n_ids = 0, 0
        self.checks, self.starts, self.counts, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, "<u4")

    def _add(self, keys: np.ndarray, checks: np.ndarray, coded: list[bytes]) -> None:
        counts = np.array([len(x) for x in coded], np.int64) // 4
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, at, keys), np.insert(self.slots, at, self.n + np.arange(len(keys)))
        self.checks, self.counts = _grown(self.checks, self.n, checks), _grown(self.counts, self.n, counts)
        self.starts = _grown(self.starts, self.n, self.n_ids + np.cumsum(counts) - counts)
        self.ids = _grown(self.ids, self.n_ids, np.frombuffer(b"".join(coded), "<u4"))
        self.n, self.n_ids = self.n + len(keys), self.n_ids + int(counts.sum())

    def of(self, data: bytes, starts: np.ndarray, ends: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of all units data[starts:ends] in a row, and how many each has; None if two units agree on the first hash only.

        inner marks units that follow the one before without white space.
        """
        if self.n > MOST_POOLED:
            self.clear()
        hashes, checks = (h(data, starts, ends) for h in _HASHES)
        hashes[inner] = ~hashes[inner]
        keys, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        own = checks[first]
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        slot = np.zeros(len(keys), np.int64)
        slot[known] = self.slots[at[known]]
        if (own[back] != checks).any() or (known.any() and (self.checks[slot[known]] != own[known]).any()):
            return None
        new = np.flatnonzero(~known)
        if len(new):
            slot[new] = self.n + np.arange(len(new))
            cut = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            self._add(keys[new], own[new], self.encode([data[i:j].decode() for i, j in cut], inner[first[new]].tolist()))
        each = slot[back]
        counts = self.counts[each] if len(each) else np.zeros(0, np.int32)
        total = np.cumsum(counts, dtype=np.int64)
        return self.ids[np.repeat(self.starts[each] - total + counts, counts) + np.arange(total[-1] if len(total) else 0)], counts


def _hash(seed: int) -> Callable[[bytes, np.ndarray, np.ndarray], np.ndarray]:
    """A 64-bit hash of each unit: differences of a running polynomial sum, scaled back to the unit's start."""
    powers: list[np.ndarray] = []

    def of(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not powers:
            for base in (seed, pow(seed, -1, 1 << 64)):
                out = np.full(MOST_BYTES + 1, np.uint64(base))
                out[0] = 1
                powers.append(np.cumprod(out, dtype=np.uint64))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * powers[0][: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * powers[1][starts])

    return of


_HASHES = [_hash(0x9E3779B97F4A7C15), _hash(0xC2B2AE3D27D4EB4F)]


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            self.word_ends = bool(json.load(f)["model"].get("end_of_word_suffix"))
        self.model = self.tokenizer.model
        self.bare = Tokenizer(self.model)
        #: Ids by what stands in the text, and, for byte-level BPE, by words without the space before them.
        self.exact, self.words = Units(self._encoded, self._encoded), Units(self._spaced, self._encoded)
        self.pool = Pool(self._units)
        # For each id, whether its token ends a word, or begins with a space.
        self.edge = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.edge[[k for t, k in self.tokenizer.get_vocab().items() if (t.endswith("</w>") if self.word_ends else t.startswith(_VISIBLE[0x20]))]] = True
        self.letters = re.compile(_LATIN if self.word_ends else " ?" + _LATIN).fullmatch
        self.glue, self.mark = _BETWEEN[self.word_ends]
        self.mark_id = self.tokenizer.encode(self.mark, add_special_tokens=False).ids[0]
        self.mark_size = len(self._whole([self.mark])[0])

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, units: list[str]) -> list[bytes]:
        """Ids of each unit by one call: units between marks, cut apart at the marks' ids."""
        ids = np.asarray(self.tokenizer.encode_batch_fast([self.glue.join(units)], add_special_tokens=False)[0].ids, "<u4")
        at = np.flatnonzero(ids == self.mark_id)
        if len(at) != len(units) - 1:
            return self._whole(units)
        data, ends = ids.tobytes(), [*(at * 4).tolist(), 4 * len(ids)]
        return [data[i:j] for i, j in zip([0, *(e + 4 for e in ends)], ends, strict=False)]

    def _latin(self, unit: str) -> bool:
        """Whether the unit is Latin letters alone (after a space, for byte-level BPE), one word to the model."""
        if unit.isascii():
            word = unit[1:] if not self.word_ends and unit[:1] == " " else unit
            return word.isalpha() and (not self.word_ends or word.islower())
        return self.letters(unit) is not None and (not self.word_ends or unit.islower())

    def _words(self, units: list[str], before: str = "") -> list[bytes]:
        """Ids of units of Latin letters, straight from the model, given as the characters that stand for their bytes."""
        joined = "\n".join(units)
        if joined.isascii():
            seen = joined.replace(" ", _VISIBLE[0x20]).split("\n")
        else:
            seen = joined.encode().decode("latin-1").translate(_VISIBLE).split(_VISIBLE[0x0A])
        if self.word_ends or before:
            # One call for all of them: their ends, or the spaces before them, show in the tokens.
            ids = np.asarray(self.bare.encode_batch_fast([[before + w for w in seen]], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(self.edge[ids])
            if len(at) == len(units):
                data, ends = ids.tobytes(), [0, *(4 * (at + 1)).tolist()] if self.word_ends else [*(4 * at).tolist(), 4 * len(ids)]
                return [data[i:j] for i, j in zip(ends, ends[1:], strict=False)]
        tokenize, ids, ends = self.model.tokenize, [], [0]
        for word in seen:
            ids += [t.id for t in tokenize(before + word)]
            ends.append(4 * len(ids))
        data = np.array(ids, "<u4").tobytes()
        return [data[i:j] for i, j in zip(ends, ends[1:], strict=False)]

    def _units(self, units: list[str], inner: list[bool]) -> list[bytes]:
        """Ids of units as a batch has them: after a space or line feed, or right after the unit before."""
        out: list[bytes | None] = [None] * len(units)
        if self.word_ends:
            plain = [k for k, u in enumerate(units) if u.isascii() and u.isalpha() and u.islower()]
        else:
            plain = [k for k, u in enumerate(units) if u.isascii() and u.isalpha() and not inner[k]]
        for at in range(0, len(plain), AT_ONCE):
            some = plain[at : at + AT_ONCE]
            for k, x in zip(some, self._words([units[k] for k in some], "" if self.word_ends else _VISIBLE[0x20]), strict=True):
                out[k] = x
        spaced = self.exact if self.word_ends else self.words
        for made, after in ((spaced.made, False), (self.exact.made, True)):
            rest = [k for k, x in enumerate(out) if x is None and inner[k] == after]
            for k, x in zip(rest, made([units[k] for k in rest]), strict=True):
                out[k] = x
        return out

    def _encoded(self, units: list[str]) -> Iterable[bytes]:
        """Ids of each unit, as it stands."""
        kinds = ([], [], [])
        for u in units:
            kinds[0 if self._latin(u) else 1 if u and not u.isspace() and self.mark not in u else 2].append(u)
        out = {}
        for encode, part in zip((self._words, self._joined, self._whole), kinds, strict=True):
            for at in range(0, len(part), AT_ONCE):
                some = part[at : at + AT_ONCE]
                out.update(zip(some, encode(some), strict=True))
        return map(out.__getitem__, units)

    def _spaced(self, words: list[str]) -> Iterable[bytes]:
        """Ids of each word after a space, or after the line feed it begins with."""
        plain = [w for w in words if w.isascii() and w.isalpha()]
        out = {}
        for at in range(0, len(plain), AT_ONCE):
            some = plain[at : at + AT_ONCE]
            out.update(zip(some, self._words(some, _VISIBLE[0x20]), strict=True))
        rest = [w for w in words if w not in out]
        lines = [w for w in rest if w[:1] == "\n"]
        mark = self._whole([self.mark])[0] if lines else b""
        out.update([(w, mark + x) for w, x in zip(lines, self.exact.of([[w[1:]] for w in lines]), strict=True)])
        spaced = [w for w in rest if w[:1] != "\n"]
        out.update(zip(spaced, self._encoded([" " + w for w in spaced]), strict=True))
        return map(out.__getitem__, words)

    def _pooled(self, texts: list[str]) -> list[bytes]:
        """Ids of texts whose units stand between single spaces; a line feed begins a unit (byte-level BPE)."""
        parts = [t.encode() for t in texts]
        data = b"".join(parts)
        a = np.frombuffer(data, np.uint8)
        at = np.flatnonzero((a == 0x20) | (a == 0x0A))
        ends = np.append(at[1:], len(a))
        # A punctuation mark after an ASCII letter, at a unit's end, is a unit of its own.
        mark = ends[(ends - at > 2)] - 1
        mark = mark[_IS_MARK[a[mark]] & _IS_LETTER[a[mark - 1]]]
        cuts = np.sort(np.concatenate([at, mark]))
        inner = _IS_MARK[a[cuts]]
        found = self.pool.of(data, cuts + (a[cuts] == 0x20), np.append(cuts[1:], len(a)), inner)
        if found is None:
            return [self._whole([t[1:]])[0] for t in texts]
        ids, counts = found
        first = np.searchsorted(cuts, np.cumsum([0, *map(len, parts)]))
        ends = np.append(0, np.cumsum(counts))[first].tolist()
        skip = 0 if self.word_ends else self.mark_size // 4
        return [ids[i + skip : j].tobytes() for i, j in zip(ends, ends[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, unsigned 32-bit little-endian."""
        pooled, whole, held = [], {}, 0

        def flush():
            whole.update(zip([k for k, _ in pooled], self._pooled([t for _, t in pooled]), strict=True))
            pooled.clear()

        for k, text in enumerate(texts):
            if self.word_ends:
                if "\u03a3" not in text:  # whose lower case depends on what follows
                    text = text.lower()
                text = " " + text.replace("\n", " ")
            else:
                rare = _RARE.search(text)
                if rare and _ODD.search(text):
                    whole[k] = self._whole([text])[0]
                    continue
                if _TOGETHER.search(text) or text[:1].isspace() if rare else any(x in text for x in _DOUBLE) or text[:1] in _SPACE or text[-1:] in _SPACE:
                    whole[k] = self.exact.of([_UNITS.findall(text)])[0]
                    continue
                text = "\n" + text
            if 4 * len(text) > MOST_BYTES:
                cut = text[1:].split(" ") if self.word_ends else text.replace("\n", " \n")[1:].split(" ")
                whole[k] = self.exact.of([cut])[0] if self.word_ends else self.words.of([cut])[0][self.mark_size :]
                continue
            if held + 4 * len(text) > MOST_BYTES:
                flush()
                held = 0
            pooled.append((k, text))
            held += 4 * len(text) if not text.isascii() else len(text)
        flush()
        return [np.frombuffer(whole[k], "<u4") for k in range(len(texts))]


@cache
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(path)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
