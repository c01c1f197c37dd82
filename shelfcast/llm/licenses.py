"""License scans: notices written as template markup, compiled to automata over words.

A template is mandatory wording with regions in markup:

    <<beginOptional>> ... <<endOptional>>     may be missing as a whole
    <<var;match="a|b";max=N>>                 one to N words, each matching the pattern
    <<var;match="a|b";max=N;min=0>>           or none

The automaton of a template accepts a run of words whose mandatory wording matches exactly, whatever
its optional and replaceable regions hold. Phrases are found beside it, wherever their words stand
together.
"""

import re
from dataclasses import dataclass

import pyarrow as pa

from shelfcast.llm.common import record_batch, ship, slices, texts

# Phrases and the labels they stand for.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Notices as commonly published with these licenses: label, wording.
TEMPLATES = (
    (
        "mit",
        "<<beginOptional>>this software is<<endOptional>> "
        '<<var;match="released|licensed|distributed|available">> under '
        "<<beginOptional>>the terms of<<endOptional>> the mit license",
    ),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of "
        '<<var;match=".*";max=12>> to deal in <<var;match=".*";max=4>> without restriction',
    ),
    (
        "apache-2.0",
        '<<beginOptional>>this <<var;match=".*">> is<<endOptional>> licensed under the apache '
        "license version 2 0",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    (
        "cc-by-variant",
        'licensed under <<beginOptional>>a<<endOptional>> cc by <<var;match="nc|sa|nd";max=2>> '
        '<<var;match="[0-9]+";max=2>>',
    ),
    (
        "gpl-3.0",
        '<<beginOptional>>this <<var;match=".*">> is<<endOptional>> licensed under the gnu '
        "general public license version 3 "
        "<<beginOptional>>or any later version<<endOptional>>",
    ),
    (
        "reserved-notice",
        'copyright <<var;match=".*";max=10;min=0>> all rights reserved',
    ),
)

_MARKUP = re.compile(r"<<(.*?)>>|([^<\s]+)")
# Separators of words become blanks: all ASCII characters but digits and small letters.
_BLANKS = bytes(
    b if b >= 128 or chr(b).isdigit() or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text):
    """Words of a text as UTF-8: A-Z lower-cased, cut at ASCII characters that are no 0-9, a-z."""
    return text.encode().lower().translate(_BLANKS).split()


@dataclass
class TemplateAutomaton:
    """States with word tests and free moves; the last state accepts."""

    tests: list  # per state: list of (word or compiled pattern, next state)
    free: list  # per state: states reached without a word

    @classmethod
    def compile(cls, markup):
        machine = cls([[]], [[]])
        opened = []
        for tag, word in _MARKUP.findall(markup):
            here = len(machine.tests) - 1
            if word:
                machine._grow((word.encode(), here + 1))
            elif tag == "beginOptional":
                opened.append(here)
            elif tag == "endOptional":
                machine.free[opened.pop()].append(here)
            else:
                field = dict(part.split("=", 1) for part in tag.split(";")[1:])
                pattern = re.compile(field["match"].strip('"').encode())
                least = int(field.get("min", 1))
                first = here
                for k in range(int(field.get("max", 1))):
                    machine._grow((pattern, len(machine.tests)))
                    if k + 1 < least:
                        first = len(machine.tests) - 1
                    elif k + 1 == least:
                        first = len(machine.tests) - 1
                end = len(machine.tests) - 1
                for state in range(first, end):
                    machine.free[state].append(end)
        return machine

    def _grow(self, test):
        self.tests[-1].append(test)
        self.tests.append([])
        self.free.append([])

    def _closed(self, states):
        todo, seen = list(states), set(states)
        while todo:
            for state in self.free[todo.pop()]:
                if state not in seen:
                    seen.add(state)
                    todo.append(state)
        return seen

    def end_of_match(self, words, start):
        """End of the longest accepted run of words from `start`, or None."""
        states, end, at = self._closed([0]), None, start
        while states:
            if len(self.tests) - 1 in states:
                end = at
            if at >= len(words):
                break
            word, reached = words[at], set()
            for state in states:
                for test, target in self.tests[state]:
                    if word == test if isinstance(test, bytes) else test.fullmatch(word):
                        reached.add(target)
            states = self._closed(reached)
            at += 1
        return end

    def first_words(self):
        """Words that can start a match; None if a pattern can."""
        tests = [t for s in self._closed([0]) for t, _ in self.tests[s]]
        return None if any(not isinstance(t, bytes) for t in tests) else set(tests)

    def needed_words(self):
        """Mandatory words: those on every way to the end."""
        reachable = {}
        for state in range(len(self.tests) - 1):
            for test, target in self.tests[state]:
                if isinstance(test, bytes) and not self._avoids(state, target):
                    reachable[test] = True
        return list(reachable)

    def _avoids(self, state, target):
        """Whether the end can be reached without the step from `state` to `target`."""
        todo, seen = [0], {0}
        while todo:
            s = todo.pop()
            steps = [t for _, t in self.tests[s] if (s, t) != (state, target)]
            for n in steps + self.free[s]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return len(self.tests) - 1 in seen


class LicenseScanner:
    """Finds phrases and template matches in texts."""

    def __init__(self, phrases=None, templates=TEMPLATES):
        phrases = PHRASES if phrases is None else phrases
        self.phrases = [(p.encode(), label) for p, label in phrases.items()]
        self.machines = []
        for label, markup in templates:
            machine = TemplateAutomaton.compile(markup)
            rarest = max(machine.needed_words(), key=len)
            self.machines.append((label, machine, machine.first_words(), rarest))
        self.hints = {max(p.split(), key=len) for p, _ in self.phrases}
        self.hints |= {rarest for *_, rarest in self.machines}

    def scan(self, text):
        """n_words, places of phrases with labels, template matches (label, start, end)."""
        words = words_of(text)
        lowered = text.encode().lower()
        if not any(hint in lowered for hint in self.hints):
            return len(words), [], []
        line, places = b" " + b" ".join(words) + b" ", []
        for phrase, label in self.phrases:
            wanted = b" " + phrase + b" "
            at, words_before, counted = line.find(wanted), 0, 0
            while at >= 0:
                words_before += line.count(b" ", counted, at)
                counted = at
                places.append((words_before, label))
                at = line.find(wanted, at + 1)
        matches = []
        for label, machine, first, rarest in self.machines:
            if rarest not in lowered:
                continue
            for start, word in enumerate(words):
                if first is None or word in first:
                    end = machine.end_of_match(words, start)
                    if end is not None:
                        matches.append((label, start, end))
        return len(words), places, matches


SCAN_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        ("n_templates", pa.int64()),
    ]
)


def scan_licenses(docs, phrases=None, templates=TEMPLATES):
    """Licenses named in every row of `docs`.

    n_base counts the places of phrases, first_word and last_word are their smallest and largest
    start (null without any). labels are those of phrases and templates, sorted and
    comma-joined. score: 1 with a template's whole wording, 0.5 with phrases only, else 0. Null and
    empty texts have no words. Rows are independent; repeated rows stay, doc_id may be null.
    """
    ship(docs.sparkSession)
    phrases = PHRASES if phrases is None else phrases

    def run(batches):
        scanner = LicenseScanner(phrases, templates)
        for part in slices(batches):
            out = {f.name: [] for f in SCAN_SCHEMA if f.name != "doc_id"}
            for text in texts(part):
                n_words, places, matches = scanner.scan(text)
                starts = [start for start, _ in places]
                base = {label for _, label in places}
                more = base | {label for label, *_ in matches}
                row = (
                    n_words,
                    len(places),
                    min(starts, default=None),
                    max(starts, default=None),
                    ",".join(sorted(base)),
                    ",".join(sorted(more)),
                    1.0 if matches else 0.5 if places else 0.0,
                    len(matches),
                )
                for column, value in zip(out.values(), row):
                    column.append(value)
            yield record_batch(SCAN_SCHEMA, doc_id=part.column("doc_id"), **out)

    kind = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, n_templates long"
    )
    return docs.select("doc_id", "text").mapInArrow(run, kind)
