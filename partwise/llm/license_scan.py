"""License scan: exact phrases, and short notices with a few errors.

A notice of k allowed errors is split into k + 1 pieces: by the pigeonhole principle each match keeps one piece whole.
So the pieces of all notices are searched exactly, in one pass of an automaton over all texts of a batch. Around a hit,
a stretch is left out if it has too few of the notice's trigrams for k errors (each error spoils three at most); only the
rest is given to the regex library, whose bounded-error matching decides, counts the edits and gives the span. Texts are
compared as words (ASCII letters lower-cased, digits, all characters beyond ASCII) joined by one space.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm._batches import LOWER, flat, pieces

#: The base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Short notices of widely used licences and their labels, as words.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0-notice",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies": "mit-condition",
    "permission to use copy modify and or distribute this software for any purpose with or without fee": "isc-grant",
    "redistribution and use in source and binary forms": "bsd-notice",
    "redistributions of source code must retain the above copyright notice": "bsd-condition",
    "neither the name of the copyright holder nor the names of its contributors": "bsd-3-clause-notice",
    "gnu general public license": "gpl-name",
    "gnu lesser general public license": "lgpl-name",
    "gnu affero general public license": "agpl-name",
    "under the terms of the gnu general public license": "gpl-notice",
    "mozilla public license": "mpl-name",
    "this source code form is subject to the terms of the mozilla public license": "mpl-2.0-notice",
    "eclipse public license": "epl-name",
    "common development and distribution license": "cddl-name",
    "boost software license": "bsl-name",
    "python software foundation license": "psf-name",
    "european union public licence": "eupl-name",
    "sil open font license": "ofl-name",
    "open database license": "odbl-name",
    "microsoft public license": "ms-pl-name",
    "academic free license": "afl-name",
    "this is free and unencumbered software released into the public domain": "unlicense-notice",
    "this software is provided as is without any express or implied warranty": "zlib-notice",
    "creative commons attribution": "cc-name",
    "this work is licensed under a creative commons": "cc-notice",
    "shared under cc by 4 0": "cc-by-notice",
    "to the extent possible under law": "cc0-notice",
}
CHARS_PER_ERROR = 10
HIT = "struct<label:string,start:long,end:long,edits:int,text:string>"
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def allowed_errors(notice: str, chars_per_error: int = CHARS_PER_ERROR) -> int:
    """One error for so many characters of a notice, however long it is."""
    return len(notice) // chars_per_error


def seeds(notice: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 pieces that make up a notice, with their places."""
    cuts = [round(i * len(notice) / (errors + 1)) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]

_SEEN = 50_000  # stretches of text whose search is remembered


class Scanner:
    """Finds phrases and notices in batches of texts."""

    def __init__(self, phrases: dict[str, str], notices: dict[str, str], chars_per_error: int = CHARS_PER_ERROR):
        import ahocorasick

        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        self.notices, found = [], {}
        self.seen: dict[tuple[int, bytes], tuple[int, int, int] | None] = {}
        for number, (notice, label) in enumerate(notices.items()):
            raw = notice.encode()
            k = allowed_errors(raw.decode("latin-1"), chars_per_error)
            pattern = regex.compile(b"(?b)(?:" + regex.escape(raw) + b"){e<=%d}" % k)
            grams = {raw[i : i + 3] for i in range(len(raw) - 2)}
            self.notices.append((label, len(raw), k, pattern, grams, len(raw) - 2 - 3 * k))
            for place, piece in seeds(raw.decode("latin-1"), k):
                found.setdefault(piece, []).append((number, place))
        self.pieces = ahocorasick.Automaton()
        for piece, users in found.items():
            self.pieces.add_word(piece, (len(piece), users))
        if found:
            self.pieces.make_automaton()

    @staticmethod
    def normal(column: pa.Array) -> tuple[bytes, np.ndarray]:
        """All texts as ` word word ` one after the other, each after a line feed, and where each starts."""
        raw, at = flat(column)
        low = LOWER[raw]
        low = np.where(_WORD[low], low, np.uint8(32))
        n = len(at) - 1
        wide = np.full(len(low) + 3 * n, 32, np.uint8)  # a row is "\n" + " " + text + " "
        lengths = np.diff(at)
        begin = at[:-1] + 3 * np.arange(n)
        wide[np.arange(len(low)) + 2 + 3 * np.repeat(np.arange(n), lengths)] = low
        wide[begin] = 10
        keep = np.ones(len(wide), bool)
        keep[1:] = (wide[1:] != 32) | (wide[:-1] != 32)
        place = np.concatenate([[0], np.cumsum(keep)])
        return wide[keep].tobytes(), place[begin]

    def nearest(self, number: int, text: bytes, windows: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
        """(start, end, edits) of a notice within windows, the best first, then the first; none overlaps one before it.

        What is left of a window beside a match is searched again. Windows are as short as the notice and its errors, and
        the same stretch of text is searched once, so the work follows the number of seeds.
        """
        _, _, _, pattern, grams, least = self.notices[number]
        heap, starts, ends = [], [], []

        def look(a: int, b: int) -> None:
            piece = text[a:b]
            found = self.seen.get((number, piece), self)
            if found is self:
                m = None if least > 0 and sum(piece[i : i + 3] in grams for i in range(len(piece) - 2)) < least else pattern.search(piece)
                found = (sum(m.fuzzy_counts), *m.span()) if m and m.end() > m.start() else None
                if len(self.seen) >= _SEEN:
                    self.seen.clear()
                self.seen[number, piece] = found
            if found:
                heapq.heappush(heap, (found[0], a + found[1], a + found[2], a, b))

        for window in windows:
            look(*window)
        while heap:
            edits, s, e, a, b = heapq.heappop(heap)
            k = bisect_right(ends, s)
            if k < len(starts) and starts[k] < e:
                cut, on = starts[k], ends[k]
            else:
                starts.insert(k, s)
                ends.insert(k, e)
                cut, on = s, e
                yield s, e, edits
            if a < cut:
                look(a, cut)
            if on < b:
                look(on, b)

    def scan(self, column: pa.Array) -> Iterator[tuple[int, list[tuple[int, str]], list[tuple]]]:
        """(words, base places [(word, label)], hits) of each text; hits are (label, start, end, edits, text) in words."""
        text, starts = self.normal(column)
        ends = np.append(starts[1:], len(text))
        view = np.frombuffer(text, np.uint8)
        spaces = np.concatenate([[0], np.cumsum(view == 32)])
        count = len(starts)
        base: list[list] = [[] for _ in range(count)]
        hits: list[list] = [[] for _ in range(count)]
        word_at = lambda row, pos: int(spaces[pos] - spaces[starts[row]])  # noqa: E731  words that start before pos, less one space
        for phrase, label in self.phrases:
            pos = text.find(phrase)
            while pos >= 0:
                row = int(np.searchsorted(starts, pos, "right")) - 1
                base[row].append((word_at(row, pos), label))
                pos = text.find(phrase, pos + 1)
        windows: dict[tuple[int, int], list[int]] = {}
        for end, (size, users) in self.pieces.iter(text.decode("latin-1")) if self.notices else ():
            pos = end + 1 - size
            row = int(np.searchsorted(starts, pos, "right")) - 1
            for number, place in users:
                windows.setdefault((row, number), []).append(pos - place)
        for (row, number), found in windows.items():
            label, length, k, *_ = self.notices[number]
            spans: list[list[int]] = []
            for begin in sorted(set(found)):  # where the notice would begin; such places within its errors are one window
                if spans and begin <= spans[-1][0] + 2 * k:
                    spans[-1][1] = begin
                else:
                    spans.append([begin, begin])
            within = [(max(int(starts[row]) + 1, a - k - 1), min(int(ends[row]), b + length + k + 1)) for a, b in spans]
            for s, e, edits in self.nearest(number, text, within):
                first = word_at(row, s) - (text[s : s + 1] != b" ")
                last = word_at(row, e) - (text[e - 1 : e] == b" ")
                hits[row].append((label, max(first, 0), last, edits, text[s:e].decode("utf-8", "replace")))
        for row in range(count):
            words = int(spaces[ends[row]] - spaces[starts[row]]) - 1
            yield max(words, 0), sorted(base[row]), sorted(hits[row], key=lambda h: (h[1], h[0]))


def scan_licenses(documents: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, chars_per_error: int = CHARS_PER_ERROR) -> DataFrame:
    """(doc_id, n_words, base array<struct(word, label)>, hits array<struct(label, start, end, edits, text)>) of every row.

    base has every place where a phrase's words stand consecutively, hits the matches of notices with at most the
    allowed errors, start to end in words (end exclusive). A null or empty text has no words and no matches; equal
    rows give equal results; an empty table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, notices, chars_per_error)
        base_type = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
        hit_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("text", pa.string())]))
        for batch in batches:
            for part in pieces(batch, "text"):
                found = list(scanner.scan(part.column(1)))
                base = [[{"word": w, "label": x} for w, x in b] for _, b, _ in found]
                hits = [[dict(zip(("label", "start", "end", "edits", "text"), h)) for h in hs] for _, _, hs in found]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _, _ in found], pa.int64()), pa.array(base, base_type), pa.array(hits, hit_type)], ["doc_id", "n_words", "base", "hits"])

    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(run, f"doc_id long, n_words long, base array<struct<word:long,label:string>>, hits array<{HIT}>")


def license_rows(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans, hits): one row per document.

    spans has each hit as label:start-end:edits, in words, separated by semicolons. score is 1 with a base phrase, else the best notice's share of characters without an edit, else 0.
    """
    found = scan_licenses(documents)
    base, words = F.array_sort(F.array_distinct(F.col("base.label"))), F.col("base.word")
    labels = F.array_sort(F.array_distinct(F.concat(F.col("base.label"), F.col("hits.label"))))
    close = F.array_max(F.transform("hits", lambda h: 1 - h["edits"] / F.greatest(F.length(h["text"]), F.lit(1))))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.greatest(close, F.lit(0.0)), F.lit(0.0))).cast("double").alias("score"),
        F.array_join(F.transform("hits", lambda h: F.format_string("%s:%d-%d:%d", h["label"], h["start"], h["end"], h["edits"])), ";").alias("spans"), "hits")
