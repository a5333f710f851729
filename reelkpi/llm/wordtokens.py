"""Token ids by the `tokenizers` library, one call per distinct word.

A text's ids are the ids of its white-space-free chunks put together, because
the vocabulary's own splitting drops white space and never crosses it (see
`splits_on_space`, which checks the file). Each worker keeps the ids of the
units it has seen in a bounded table, so the library runs once for a word and
not once for each of its occurrences.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from reelkpi.llm.common import SMALL, Places, run_hashes, worker_state

#: Units whose ids a worker keeps; beyond that the table starts anew.
UNIT_CACHE = 1_000_000
#: Bytes of text whose units are found together.
PART_BYTES = 1 << 20
#: Chunks given to the library at once, and words in one text for it.
LIBRARY_BATCH, WORDS_A_TEXT = 50_000, 400

SPACE, LETTER, MARK, OTHER = 0, 1, 2, 3
CLASS = np.full(256, OTHER, np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
CLASS[97:123] = CLASS[65:91] = LETTER
CLASS[[ord(c) for c in ".,;:!?|*$%&#"]] = MARK


def splits_on_space(path: str) -> bool:
    """True if the tokenizer file drops white space between its pieces, keeps no
    state across pieces and adds no prefix space, so chunks encode alone."""
    spec = json.load(open(path, encoding="utf-8"))
    steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
    split = [s for s in steps if s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"]]
    prefix = any(s.get("add_prefix_space") for s in steps)
    tokens = spec["added_tokens"]
    return bool(split) and r"\s" in split[0]["pattern"]["Regex"] and not prefix and not any(
        t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in tokens)


class UnitEncoder:
    """ids of texts as little-endian unsigned 32-bit bytes.

    A chunk of plain letters (ASCII, Latin-1) and plain marks is cut where the
    one passes into the other, and its letters are made small, as the file's own
    rules would; any other chunk stays whole and as it is. These units are found
    and hashed (64 bits) for a whole slice of text in numpy, and only distinct
    units that the worker has not seen go to the library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.by_chunk = splits_on_space(path)
        spec = json.load(open(path, encoding="utf-8"))["model"]
        suffix = spec.get("end_of_word_suffix")
        # True for ids that end a piece; known only where the vocabulary marks word ends
        self.ends = suffix and np.array([t.endswith(suffix) for t, _ in sorted(spec["vocab"].items(), key=lambda x: x[1])])
        self._forget()

    def _forget(self) -> None:
        self.places = Places(np.zeros(0, np.int64))
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.pool, self.used = np.zeros(1 << 18, "<u4"), 0

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, dtype="<u4") for at in range(0, len(texts), LIBRARY_BATCH)
                for e in self.library.encode_batch(texts[at:at + LIBRARY_BATCH], add_special_tokens=False)]

    def _flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        ids = self._library(texts)
        return (np.concatenate(ids) if ids else np.zeros(0, "<u4")), np.array([len(x) for x in ids], dtype=np.int64)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters only: each is one piece, so many go into
        one text and the ids that end a piece part them again."""
        if self.ends is None:
            return self._flat(words)
        flat, _ = self._flat([" ".join(words[i:i + WORDS_A_TEXT]) for i in range(0, len(words), WORDS_A_TEXT)])
        return flat, np.diff(np.flatnonzero(self.ends[flat]), prepend=-1)

    def _learn(self, keys: np.ndarray, units: list[bytes], letters: np.ndarray) -> None:
        for which, make in ((letters, self._words), (~letters, self._flat)):
            flat, lengths = make([units[i].decode("utf-8") for i in np.flatnonzero(which).tolist()])
            first, n = len(self.places.keys), len(lengths)
            while first + n > len(self.starts):
                self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
            while self.used + len(flat) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.starts[first:first + n] = self.used + np.cumsum(lengths) - lengths
            self.lengths[first:first + n] = lengths
            self.pool[self.used:self.used + len(flat)] = flat
            self.used += len(flat)
            self.places.add(keys[which])

    def _units(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes with plain letters made small, starts, ends, letters only) of the units of raw, which ends in a space."""
        kind = CLASS[raw]
        small = SMALL[raw]
        lead = np.flatnonzero(raw == 0xC3)  # two-byte letters of Latin-1, without the signs of times and division
        if len(lead):
            lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
            kind[lead] = kind[lead + 1] = LETTER
            capital = lead[raw[lead + 1] <= 0x9E] + 1
            small[capital] += 32
        if (kind == OTHER).any():  # chunks with such bytes stay whole, and as they are
            solid = kind != SPACE
            edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
            edges = np.concatenate([[0], edges]) if solid[0] else edges
            begin, end = edges[::2], edges[1::2]
            mixed = np.maximum.reduceat(kind, begin) == OTHER  # spaces between count least
            for a, b in zip(begin[mixed].tolist(), end[mixed].tolist()):
                kind[a:b] = OTHER
                small[a:b] = raw[a:b]
        cut = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        cut = np.concatenate([[0], cut, [len(raw)]])
        starts, ends = cut[:-1], cut[1:]
        real = kind[starts] != SPACE
        starts, ends = starts[real], ends[real]
        return small, starts, ends, kind[starts] == LETTER

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_chunk:
            return [x.tobytes() for x in self._library(texts)]
        out, part, size = [], [], 0
        for t in texts:
            raw = t.encode("utf-8")
            if part and size + len(raw) > PART_BYTES:
                out += self._part(part)
                part, size = [], 0
            part.append(raw)
            size += len(raw)
        return out + self._part(part) if part else out

    def _part(self, parts: list[bytes]) -> list[bytes]:
        if len(self.places.keys) > UNIT_CACHE:
            self._forget()
        raw = np.frombuffer(b" ".join([*parts, b""]), np.uint8)
        small, starts, ends, letters = self._units(raw)
        keys = run_hashes(small, starts, ends).view(np.int64)
        at = self.places.find(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            distinct, first = np.unique(keys[new], return_index=True)
            first = new[first]
            flat = small.tobytes()
            spans = zip(starts[first].tolist(), ends[first].tolist())
            self._learn(distinct, [flat[a:b] for a, b in spans], letters[first])
            at[new] = self.places.find(keys[new])
        lengths = self.lengths[at]
        before = np.cumsum(lengths) - lengths
        total = int(lengths.sum())
        ids = self.pool[np.repeat(self.starts[at] - before, lengths) + np.arange(total)].tobytes()
        sizes = np.array([len(p) + 1 for p in parts])
        unit_of = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
        bounds = (4 * np.append(before, total)[unit_of]).tolist()
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def word_encoder(path: str) -> UnitEncoder:
    return worker_state(f"words:{path}", lambda: UnitEncoder(path))
