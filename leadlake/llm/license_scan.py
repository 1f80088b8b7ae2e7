"""Licence detection: ordered signature rules behind a keyword gate.

A text, white space collapsed and comment marks at line beginnings taken off, passes one
keyword automaton; only rules of whose literals one occurred run their regex. Detections are taken
in the order of priority, then length, then start; one that lies inside a kept
detection of the same or a higher priority is suppressed. The kept labels are the method's own; the base labels (places where
a phrase's words stand consecutively) are always kept.

Defined results: a null text is an empty text with no words, no labels and score
0; texts are scanned whole whatever their length; repeated rows repeat their
result; the score is that of the strongest detection (priority / 100), 0.6 at
least where a base phrase stands.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import map_texts
from leadlake.llm.license_rules import Rule, rules

#: Phrases and their labels: fixed values.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Every byte of a word (0-9, a-z, and all of UTF-8 beyond ASCII) to itself, all else to a space.
_TO_WORDS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_BASE_HINT = re.compile(rb"license|cc")


def base_places(lowered: bytes) -> tuple[int, list[tuple[int, str]]]:
    """Number of words, and (word index, label) of every phrase place in ASCII-lowered UTF-8."""
    words = lowered.translate(_TO_WORDS).split()
    if not _BASE_HINT.search(lowered):
        return len(words), []
    places, flat = [], b" " + b" ".join(words) + b" "
    for phrase, label in BASE_PHRASES.items():
        sought, at = f" {phrase} ".encode(), -1
        while (at := flat.find(sought, at + 1)) >= 0:
            places.append((flat.count(b" ", 0, at), label))
    return len(words), sorted(places)


_COMMENT = re.compile(r"[\r\n]\s*(?:(?:[*#;%!>]|//|--)+(?=\s|$))?")


def flat(text: str) -> str:
    """The text on one line: white space, and comment marks that begin a line, become single spaces."""
    return " ".join(_COMMENT.sub(" ", text).split())


class Scanner:
    """The rules with their gate, built once per task."""

    def __init__(self, ordered: list[Rule] | None = None):
        self.rules = rules() if ordered is None else ordered
        self.gate = ahocorasick.Automaton()
        by_word: dict[str, list[int]] = {}
        for k, r in enumerate(self.rules):
            for w in r.gates:
                by_word.setdefault(w, []).append(k)
        for w, ks in by_word.items():
            self.gate.add_word(w, tuple(ks))
        self.gate.make_automaton()

    def active(self, text: str) -> list[int]:
        """The rules that may match in the flat, lower-cased text."""
        return sorted({k for _, ks in self.gate.iter(text) for k in ks})

    def detect(self, text: str) -> list[tuple[int, int, Rule]]:
        """Kept detections (start, end, rule) in the flat lower-cased text, the strongest first."""
        text = flat(text)
        found = []
        for k in self.active(text):
            place = "at" if "at" in self.rules[k].pattern.groupindex else 0
            found += [(*m.span(place), self.rules[k]) for m in self.rules[k].pattern.finditer(text)]
        found.sort(key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label))
        kept: list[tuple[int, int, Rule]] = []
        near: dict[int, list[tuple[int, int]]] = {}  # kept intervals by the stretches of 256 characters they touch
        for d in found:
            if not any(s <= d[0] and d[1] <= e for s, e in near.get(d[0] >> 8, ())):
                kept.append(d)
                for stretch in range(d[0] >> 8, (d[1] >> 8) + 1):
                    near.setdefault(stretch, []).append(d[:2])
        return kept

    def scan(self, text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
        lowered = (text or "").encode("utf-8", "surrogatepass").lower()
        n_words, places = base_places(lowered)
        kept = self.detect(lowered.decode("utf-8", "surrogatepass"))
        base = sorted({label for _, label in places})
        labels = sorted({*base, *(d[2].label for d in kept)})
        score = max([0.0, *(d[2].priority / 100 for d in kept), *([0.6] if base else [])])
        starts = [p for p, _ in places]
        return (n_words, len(places), min(starts, default=None), max(starts, default=None),
                ",".join(base), ",".join(labels), score)


_FIELDS = {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long",
           "base_labels": "string", "labels": "string", "score": "double"}


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the scan's columns for every row."""

    def scanner():
        scan = Scanner().scan
        return lambda texts: [scan(t) for t in texts]

    return map_texts(docs.select(F.col(id_col), F.col(text_col).alias("_text")), scanner, _FIELDS)
