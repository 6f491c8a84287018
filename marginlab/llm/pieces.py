"""Encoding texts with a tokenizer of the ``tokenizers`` library, piece by piece.

A text is cut at safe boundaries: a single space between two characters that are
not white space. No pre-token of the supported tokenizers reaches over such a
space (it may begin with it), so the ids of a text are those of its pieces in
turn, and the ids of a piece do not depend on its neighbours. Runs of white space
stay inside a piece. Pieces repeat a lot, so each worker remembers those it has
met (a bounded number) and hands only new ones to the library, in batches
balanced by bytes.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Collection, Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handed to the library at once, and pieces a worker remembers.
BATCH_BYTES = 256 << 10
REMEMBERED = 800_000

#: Punctuation and letters before it that can make it a pre-token of its own.
_MARKS = ".,!?;:|%#$&*"
_LETTERS = [c for c in map(chr, range(0x41, 0x180)) if c.isalpha()]


def _tail(tokenizer) -> re.Pattern:
    """Matches the punctuation at the end of a piece that the tokenizer encodes apart from what is before it.

    Only after letters that stay one letter when they are normalised, and only if
    the pre-tokenizer cuts between each of them and each mark.
    """

    def normalised(text: str) -> str:
        return tokenizer.normalizer.normalize_str(text) if tokenizer.normalizer else text

    def apart(letter: str, mark: str) -> bool:
        text = normalised("x" + letter + mark)
        cut = [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)] if tokenizer.pre_tokenizer else []
        return len(text) == 3 and text[1].isalpha() and text[2] == mark and cut == [text[:2], mark]

    letters = [c for c in _LETTERS if all(apart(c, m) for m in _MARKS)]
    if not letters:
        return re.compile(r"(?!)")
    return re.compile(f"(?<=[{''.join(letters)}])[{re.escape(_MARKS)}]+\\Z")


def _load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class PieceCounter:
    """Numbers of tokens, by a tokenizer that drops white space between words."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.tokenizer = _load(path)
        self.remembered, self.known = remembered, {}
        self.tail = _tail(self.tokenizer)

    def cut(self, texts: list[str | None]) -> list[list[str]]:
        """The pieces of each text, all of them known from here on."""
        cut = [pieces(t, "") if t else [] for t in texts]
        new = set(filterfalse(self.known.__contains__, chain.from_iterable(cut)))
        if len(self.known) + 2 * len(new) > self.remembered:
            # Pieces of the present batch stay: they hold the frequent ones.
            self.known = {p: self.known[p] for p in set().union(*cut).intersection(self.known)}
        self._add(new)
        return cut

    def _add(self, new: set[str]) -> None:
        known, split = self.known, {}
        for p in new:
            if found := self.tail.search(p):
                at = found.start()
                split[p] = (p[:at], p[at:])
        single = new.difference(split).union(*split.values()).difference(known)
        for batch in balanced(single, BATCH_BYTES):
            self.learn(batch)
        for p, (head, tail) in split.items():
            known[p] = known[head] + known[tail]

    def learn(self, batch: list[str]) -> None:
        found = self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
        self.known.update(zip(batch, map(len, found)))

    def count(self, texts: list[str | None]) -> list[int]:
        cut = self.cut(texts)
        return [sum(map(self.known.__getitem__, p)) for p in cut]


class PieceEncoder:
    """Ids, by a byte-level tokenizer whose words keep the space before them.

    A text is a first piece, words, and a last piece if it ends with white space.
    ``known`` has the ids of words, each with the space before it (its key is
    without), and ``parts`` those of strings of plain letters or marks without one.
    A new word is cut where the pre-tokenizer cuts it, so that most is known after
    all; new letters go to the library's model, other words to the library as they are.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.tokenizer = _load(path)
        self.model = self.tokenizer.model
        self.remembered, self.known, self.parts = remembered, {}, {}
        self._bytes = _token_bytes(self.tokenizer)
        self.plain = _Plain(self.tokenizer)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit numbers; a null has none, like an empty text."""
        return strings(self.encode_array(pa.array(texts, pa.string())))

    def encode_array(self, texts: pa.Array) -> pa.Array:
        """``encode`` of an Arrow array: each distinct word of it is looked up once."""
        if not len(texts):
            return pa.array([], pa.binary())
        texts = pc.fill_null(texts, "")
        starts, at_start, firsts, words = _split(texts)
        names = strings(words.dictionary)
        new = list(filterfalse(self.known.__contains__, names))
        # Words that are empty or have white space at an end never become known.
        loose = {w for w in new if not w or w.strip() != w}
        several = np.diff(np.append(starts, len(at_start))) > 1
        odd = several & np.array([not f or f[-1].isspace() for f in firsts], bool)
        if loose:
            rows = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(at_start))))[~at_start]
            of_loose = np.array([w in loose for w in names])
            odd[rows[of_loose[words.indices.to_numpy()]]] = True
        if odd.any():
            # A space beside white space: these texts are cut with more care.
            slow = self._encode_pieces(texts.filter(pa.array(odd)).to_pylist())
            if odd.all():
                return pa.array(slow, pa.binary())
            fast = self.encode_array(texts.filter(pa.array(~odd)))
            place = np.empty(len(odd), np.int64)
            place[np.flatnonzero(~odd)] = np.arange(len(fast))
            place[np.flatnonzero(odd)] = len(fast) + np.arange(len(slow))
            return pa.concat_arrays([fast, pa.array(slow, pa.binary())]).take(pa.array(place))
        ends = self._learn(new, names, firsts)
        ids = pa.array([*map(self.known.__getitem__, names), *map(ends.__getitem__, firsts)], pa.binary())
        place = np.empty(len(at_start), np.int32)
        place[~at_start] = words.indices.to_numpy()
        place[at_start] = len(names) + np.arange(len(firsts))
        offsets = pa.array(np.append(starts, len(at_start)).astype(np.int32))
        return pc.binary_join(pa.ListArray.from_arrays(offsets, ids.take(pa.array(place))), b"")

    def _encode_pieces(self, texts: list[str]) -> list[bytes]:
        """Ids by the pieces of ``pieces``; one that ends with white space can only be the last."""
        cut = [pieces(t) for t in texts]
        firsts, lasts = [c[0] for c in cut], [c.pop() if len(c) > 1 and c[-1][-1].isspace() else "" for c in cut]
        words = [[p[1:] for p in c[1:]] for c in cut]
        names = set(chain.from_iterable(words))
        ends = self._learn(names.difference(self.known), names, [*firsts, *lasts])
        get = self.known.__getitem__
        return [ends[a] + b"".join(map(get, w)) + ends[z] for a, w, z in zip(firsts, words, lasts)]

    def _learn(self, new: Collection[str], words: Iterable[str], ends: Iterable[str]) -> dict[str, bytes]:
        """Make the ``new`` ones of distinct ``words`` known; ids of first and last pieces."""
        if len(self.known) + len(self.parts) + 2 * len(new) > self.remembered:
            # Words of the present batch stay: they hold the frequent ones.
            self.known = {w: self.known[w] for w in words if w in self.known}
            self.parts = {}
        new = pa.array(new, pa.string())
        stems, marks, plain = self.plain.stems(new)
        stems, marks = stems.dictionary_encode(), marks.dictionary_encode()
        after = strings(marks.dictionary)
        found = self._add(set(strings(new.filter(pc.invert(plain)))), {*ends, *after})
        names = strings(stems.dictionary)
        self._add_letters([w for w in names if w not in self.known])
        of_stem = pa.array(map(self.known.__getitem__, names), pa.binary()).take(stems.indices)
        of_marks = pa.array(map(found.__getitem__, after), pa.binary()).take(marks.indices)
        ids = pc.binary_join_element_wise(of_stem, of_marks, b"")
        self.known.update(zip(strings(new.filter(plain)), strings(ids)))
        return found

    def _add_letters(self, words: list[str]) -> None:
        ids, sizes, tokenize, byte_level = [], [], self.model.tokenize, self.plain.byte_level
        space = byte_level(" ")
        for w in words:
            found = [t.id for t in tokenize(space + w if w.isascii() else byte_level(" " + w))]
            sizes.append(len(found))
            ids += found
        raw, ends = np.array(ids, "<u4").tobytes(), (np.cumsum(sizes, dtype=np.int64) * 4).tolist()
        at = 0
        for w, to in zip(words, ends):
            self.known[w] = raw[at:to]
            at = to

    def _add(self, words: set[str], ends: set[str]) -> dict[str, bytes]:
        """Make words of any kind known; ids of the first and last pieces."""
        known, plain = self.known, self.plain
        cut = {p: plain.cut(p) for p in chain(map(" ".__add__, words), ends)}
        ids, new = {}, []
        for p in set(chain.from_iterable(cut.values())):
            found = known.get(p[1:]) if p[0] == " " else self.parts.get(p)
            if found is None:
                new.append(p)
            else:
                ids[p] = found
        letters = list(filter(plain.letters, new))
        for p, found in zip(letters, map(self._model_ids, letters)):
            ids[p] = found
            if p[0] == " ":
                known[p[1:]] = found
            else:
                self.parts[p] = found
        for batch in balanced(set(new).difference(letters), BATCH_BYTES):
            learnt = self._library_ids(batch)
            ids.update(learnt)
            self.parts.update((p, x) for p, x in learnt.items() if p[0] != " " and len(p) < 64)
        for p, parts in cut.items():
            if len(parts) > 1:
                ids[p] = b"".join([ids[x] for x in parts])
        for w in words:
            known[w] = ids[" " + w]
        return {"": b"", **{p: ids[p] for p in ends if p}}

    def _model_ids(self, part: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(self.plain.byte_level(part))]).tobytes()

    def _library_ids(self, batch: list[str]) -> dict[str, bytes]:
        # Pieces that begin with a space join into one text; the bytes of its
        # tokens tell where each piece ends. Others are encoded one by one.
        out = {}
        joined = [p for p in batch if len(p) > 1 and p[0] == " " and not p[1].isspace() and not p[-1].isspace()]
        alone = set(batch).difference(joined)
        for some in balanced(joined, 4096):
            ids = array("I", self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids)
            ends = np.cumsum(self._bytes[np.frombuffer(ids, np.uint32)])
            lengths = np.cumsum([len(p.encode()) for p in some])
            cuts = np.searchsorted(ends, lengths)
            if len(ends) == 0 or not np.array_equal(ends[np.minimum(cuts, len(ends) - 1)], lengths):
                alone.update(some)
                continue
            raw, at = ids.tobytes(), 0
            for p, to in zip(some, ((cuts + 1) * 4).tolist()):
                out[p] = raw[at:to]
                at = to
        alone = list(alone)
        found = self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)
        out.update((p, array("I", x.ids).tobytes()) for p, x in zip(alone, found))
        return out


def strings(values: pa.Array) -> list:
    """``to_pylist`` of strings or bytes, faster."""
    return values.to_numpy(zero_copy_only=False).tolist()


def _split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], pa.DictionaryArray]:
    """Texts cut at each space: where each begins among all parts, whether a part is the first of its text, the first parts, the others."""
    cut = pc.split_pattern(texts, pattern=" ")
    parts, starts = cut.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))[:-1]]).astype(np.int64)
    at_start = np.zeros(len(parts), bool)
    at_start[starts] = True
    return starts, at_start, strings(parts.filter(pa.array(at_start))), parts.filter(pa.array(~at_start)).dictionary_encode()


class _Plain:
    """Cuts strings of Latin letters, marks and single line ends as a byte-level pre-tokenizer does.

    Of the letters and marks, those that the tokenizer was seen to cut so; none
    if it has a normalizer or an added token of such characters alone.
    """

    def __init__(self, tokenizer):
        self._table = _byte_level_table()
        within = tokenizer.pre_tokenizer.pre_tokenize_str if tokenizer.pre_tokenizer else lambda text: []

        def as_cut(*parts: str) -> bool:
            return [x for x, _ in within("".join(parts))] == [self.byte_level(p) for p in parts]

        marks = [m for m in _MARKS if as_cut("x", m) and as_cut(" " + m, "x") and as_cut(m, "\n", "x") and as_cut("x", "\n", m)]
        if not all(as_cut(" x", m + n, "\n", m + n) for m in marks for n in marks):
            marks = []
        letters = [
            c for c in _LETTERS
            if as_cut(f" x{c}x", "\n", c) and as_cut(f"{c}x{c}") and all(as_cut(f" {c}", m, c) for m in marks)
        ]
        plain = {*letters, *marks, " ", "\n"}
        if tokenizer.normalizer or not letters or not marks or any(plain.issuperset(t.content) for t in tokenizer.get_added_tokens_decoder().values()):
            self._word = self._whole = re.compile("(?!)")
            self.letters, self._characters = self._word.fullmatch, None
            return
        self._characters = "".join(letters), "".join(marks)
        a, m = self._characters[0], re.escape(self._characters[1])
        self._whole = re.compile(f" ?[{a}{m}](?:[{a}{m}]|\n(?=[{a}{m}]))*")
        self._part = re.compile(f" ?[{a}]+| ?[{m}]+|\n")
        self._word = re.compile(f"( ?[{a}]+)([{m}]+)?")
        #: Whether a part is of letters.
        self.letters = re.compile(f" ?[{a}]+").fullmatch

    def stems(self, words: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
        """Letters and marks after them of the words that have just these, and which words those are."""
        if not self._characters:
            return words.slice(0, 0), words.slice(0, 0), pa.array(np.zeros(len(words), bool))
        letters, marks = self._characters
        stem, rest = pc.utf8_rtrim(words, characters=marks), pc.utf8_ltrim(words, characters=letters)
        plain = pc.and_(pc.not_equal(stem, ""), pc.equal(pc.utf8_ltrim(rest, characters=marks), ""))
        return stem.filter(plain), rest.filter(plain), plain

    def cut(self, piece: str) -> Sequence[str]:
        """The parts of a piece that are encoded apart; the piece itself if it is not plain, nothing if it is empty."""
        if found := self._word.fullmatch(piece):
            return found.groups() if found[2] else found.groups()[:1]
        if self._whole.fullmatch(piece):
            return self._part.findall(piece)
        return (piece,) if piece else ()

    def byte_level(self, part: str) -> str:
        """One character for each byte, as the model has them."""
        if part.isascii():
            return part.replace(" ", self._table[0x20]).replace("\n", self._table[0x0A])
        return part.encode().decode("latin-1").translate(self._table)


def _byte_level_table() -> dict[int, str]:
    """Printable bytes stand for themselves, the others for the characters from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(0x100) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(0x100 + i) for i, b in enumerate(others)}}


def _token_bytes(tokenizer) -> np.ndarray:
    """Bytes of text behind each id. A byte-level token has one character for each byte."""
    added = tokenizer.get_added_tokens_decoder()
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, i in vocabulary.items():
        out[i] = len(token.encode()) if i in added else len(token)
    return out


def pieces(text: str, space: str = " ") -> list[str]:
    """The text cut at safe boundaries; each piece but the first begins with ``space``."""
    parts = text.split(" ")
    for part in parts:
        if not part or part[0].isspace() or part[-1].isspace():
            break
    else:
        return [parts[0], *map(space.__add__, parts[1:])] if space else parts
    out = [parts[0]]
    for before, part in zip(parts, parts[1:]):
        safe = before and part and not before[-1].isspace() and not part[0].isspace()
        if safe:
            out.append(space + part)
        else:
            out[-1] += " " + part
    return out


def balanced(texts: Iterable[str], most: int) -> Iterator[list[str]]:
    """The texts in batches of about ``most`` bytes of UTF-8."""
    batch, held = [], 0
    for t in texts:
        batch.append(t)
        held += len(t) if t.isascii() else len(t.encode())
        if held >= most:
            yield batch
            batch, held = [], 0
    if batch:
        yield batch


def by_size(texts: pa.Array, most: int) -> Iterator[list[str | None]]:
    """The texts in lists of about ``most`` bytes each; no other text is held as a Python string meanwhile."""
    return (some.to_pylist() for some in slices(texts, most))


def slices(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """The texts in slices of about ``most`` bytes each."""
    start, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), 1):
        held += n
        if held >= most or i == len(texts):
            yield texts.slice(start, i - start)
            start, held = i, 0


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    """The worker's counter for a tokenizer file."""
    return PieceCounter(path)


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file."""
    return PieceEncoder(path)
