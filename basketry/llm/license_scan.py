"""License scans: exact phrases, and short notices within a few edits.

A notice that may have ``k`` edits is cut into k + 1 pieces: whatever the
edits, one piece stands unchanged (pigeonhole).  All pieces are searched at
once by one Aho-Corasick automaton; a hit places the notice to within k
characters, and the regex library's bounded-error match verifies the edits in
that window and reports the span.  Phrases are found the same way, with no
edits between whole words.

Phrases give base labels.  Notices give labels of their own, and never take
one away.  The score is 1 for a phrase, for a notice the share of its
characters that are unchanged, at its best match.

Cases: a null text counts as empty and has no words; repeated rows are
scanned one by one; texts are scanned whole, in one pass, and only windows
around hits are matched; an empty table gives an empty one; other columns are
not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import arrow_batches, text_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases of words, and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"),
           ("cc by", "cc-by"), ("mit license", "mit"))

#: Opening lines of short public notices, their labels, and the
#: edits allowed.
NOTICES = (
    ("this work is licensed under the gnu general public license", "gpl-notice", 4),
    ("this program is free software: you can redistribute it and/or modify it", "gpl-notice", 5),
    ("licensed under the apache license, version 2.0", "apache-notice", 3),
    ("permission is hereby granted, free of charge, to any person obtaining a copy", "mit-notice", 5),
    ("released under the mit license", "mit-notice", 3),
    ("licensed under cc by", "cc-notice", 2),
    ("this work is licensed under a creative commons attribution", "cc-notice", 4),
    ("redistribution and use in source and binary forms, with or without modification", "bsd-notice", 5),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-notice", 5),
    ("spdx-license-identifier:", "spdx-notice", 2),
)

SPAN = "struct<label:string,first:int,last:int,edits:int>"


def seeds(notice: str, edits: int) -> list[tuple[int, str]]:
    """(start, piece) of the edits + 1 pieces that a notice is cut into."""
    n = edits + 1
    cuts = [len(notice) * i // n for i in range(n + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Scanner:
    """Finds phrases and notices in lower-cased texts."""

    def __init__(self, phrases: Sequence[tuple[str, str]], notices: Sequence[tuple[str, str, int]]):
        import ahocorasick
        import regex

        self.word = re.compile(WORD)
        self.phrases = [(re.compile(f"(?<!{WORD[:-1]}){GAP.join(map(re.escape, p.split()))}(?!{WORD[:-1]})"), label)
                        for p, label in phrases]
        self.notices = [(text, label, k, regex.compile(f"(?b)(?:{regex.escape(text)}){{e<={k}}}")) for text, label, k in notices]
        found: dict[str, list] = {}
        for i, (p, _) in enumerate(phrases):  # a phrase's longest word leads to it
            found.setdefault(max(p.split(), key=len), []).append((True, i, 0))
        for i, (text, _, k) in enumerate(notices):
            for at, piece in seeds(text, k):
                found.setdefault(piece, []).append((False, i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, list[tuple[str, int, int, int]], list[tuple[str, int, int, int]], float]:
        """(number of words, places of phrases by words, spans of notices by
        characters, score)."""
        text = text.encode().lower().decode()  # bytes: A-Z only
        phrases: set[int] = set()
        windows: dict[int, list[int]] = {}
        for end, (size, uses) in self.automaton.iter(text):
            for base, i, at in uses:
                if base:
                    phrases.add(i)
                else:
                    windows.setdefault(i, []).append(end + 1 - size - at)
        starts = [m.start() for m in self.word.finditer(text)] if phrases else None
        n = len(starts) if starts is not None else len(self.word.findall(text))
        places = []
        for i in sorted(phrases):
            pattern, label = self.phrases[i]
            at = 0
            while m := pattern.search(text, at):  # places may share words
                places.append((label, w := bisect_right(starts, m.start()) - 1, m.start(), m.end()))
                at = m.start() + 1
        spans, score = [], 1.0 if places else 0.0
        for i, hits in windows.items():
            notice, label, k, pattern = self.notices[i]
            done = -1
            for at in sorted(set(hits)):
                a, b = max(at - k, done, 0), at + len(notice) + k
                m = pattern.search(text, a, max(a, b))
                if m and m.start() >= done:
                    edits = sum(m.fuzzy_counts)
                    spans.append((label, m.start(), m.end(), edits))
                    score = max(score, 1 - edits / len(notice))
                    done = m.end()
        return n, places, spans, score


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         phrases: Sequence[tuple[str, str]] = PHRASES, notices: Sequence[tuple[str, str, int]] = NOTICES) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    spans) of every row; spans are (label, first and last character, edits),
    phrases and notices alike."""
    def run(batches):
        scanner = Scanner(phrases, notices)
        for b in batches:
            out: list[list] = [[] for _ in range(8)]
            for text in b.column(1).to_pylist():
                n, places, spans, score = scanner.scan(text)
                base = sorted({p[0] for p in places})
                at = [p[1] for p in places]
                row = (n, len(places), min(at, default=None), max(at, default=None), ",".join(base),
                       ",".join(sorted({*base, *(s[0] for s in spans)})), score,
                       [{"label": x, "first": f, "last": t, "edits": e}
                        for x, f, t, e in [*((p[0], p[2], p[3], 0) for p in places), *spans]])
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
                [("label", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("edits", pa.int32())]))]
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, out, kinds)], names)

    arrow_batches(docs.sparkSession)
    names = [id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    kind = docs.schema[id_col].dataType.simpleString()
    d = docs.select(F.col(id_col), text_of(text_col).alias("_ls_text"))
    return d.mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, "
                             f"base_labels string, labels string, score double, spans array<{SPAN}>")
