"""License scans: identifier tags and notice phrases by Aho-Corasick, expressions by shunting-yard."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from shelftalk.llm.common import arrow_rows, text_runs, whole_texts

#: Phrases that must be found, and their labels (fixed values).
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Further notice phrases.
NOTICE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "eclipse public license": "epl",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "public domain": "public-domain",
    "creative commons": "creative-commons",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "isc license": "isc",
    "zlib license": "zlib",
    "boost software license": "bsl-1.0",
    "artistic license": "artistic",
    "free documentation license": "gfdl",
    "open font license": "ofl",
    "open software license": "osl",
    "academic free license": "afl",
    "open database license": "odbl",
    "european union public licence": "eupl",
    "common development and distribution license": "cddl",
    "common public license": "cpl",
    "microsoft public license": "ms-pl",
    "python software foundation license": "psf",
    "universal permissive license": "upl",
    "server side public license": "sspl",
    "business source license": "busl",
    "this is free and unencumbered software": "unlicense",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software": "isc",
}
#: Tags after which a licence expression follows on the same line.
TAGS = ("spdx-license-identifier:", "license-expression:", "license-identifier:")
#: How much a licence restricts use, 0 to 1; the longest prefix of an identifier counts.
RESTRICTION = {
    "public-domain": 0.05, "cc0": 0.05, "unlicense": 0.05,
    "mit": 0.1, "isc": 0.1, "bsd": 0.1, "apache": 0.15, "zlib": 0.1,
    "cc-by": 0.2, "creative-commons": 0.2,
    "bsl-1.0": 0.1, "upl": 0.1, "psf": 0.15, "artistic": 0.2, "afl": 0.15, "ofl": 0.2,
    "mpl": 0.4, "epl": 0.4, "cc-by-sa": 0.4, "cddl": 0.4, "cpl": 0.4, "ms-pl": 0.3, "odbl": 0.4,
    "lgpl": 0.5, "eupl": 0.5, "osl": 0.6, "gfdl": 0.6,
    "gpl": 0.7, "agpl": 0.8, "cc-by-nd": 0.8, "cc-by-nc": 0.8, "sspl": 0.9, "busl": 0.9,
    "proprietary": 1.0, "licenseref-proprietary": 1.0, "reserved": 1.0,
}
UNKNOWN, EXCEPTION_KEEPS = 0.5, 0.5
INVALID = "invalid-expression"
_BREAK = re.compile("[\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_TOKEN = re.compile(r"\s*([()]|[a-z0-9](?:[a-z0-9.+:-]*[a-z0-9+])?)")
_BINDS = {"or": 1, "and": 2, "with": 3}


def restriction(identifier: str) -> float:
    known = [k for k in RESTRICTION if identifier == k or identifier.startswith(k + "-")]
    return RESTRICTION[max(known, key=len)] if known else UNKNOWN


def to_postfix(expression: str) -> list[str]:
    """Shunting-yard: operands and operators in postfix order; ValueError if malformed."""
    out: list[str] = []
    stack: list[str] = []
    at, operand = 0, True  # operand: whether one is due
    text = expression.strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(expression)
        token, at = m[1], m.end()
        if token == "(":
            if not operand:
                raise ValueError(expression)
            stack.append(token)
        elif token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if operand or not stack:
                raise ValueError(expression)
            stack.pop()
        elif token in _BINDS:
            if operand:
                raise ValueError(expression)
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[token]:
                out.append(stack.pop())
            stack.append(token)
            operand = True
        else:
            if not operand:
                raise ValueError(expression)
            out.append(token)
            operand = False
    if operand or "(" in stack:
        raise ValueError(expression)
    return out + stack[::-1]


def leading_expression(line: str) -> str:
    """The longest start of ``line`` that is a whole expression; empty if there is none.

    It ends before a character that no token holds (``*/``, ``-->``, a quote, a comma) or a token
    that can't follow, and takes a dangling operator or an open parenthesis with it.
    """
    at = whole = depth = 0
    operand = True  # whether one is due
    while m := _TOKEN.match(line, at):
        token = m[1]
        if (token in _BINDS or token == ")") == operand or (token == ")" and not depth):
            break
        at = m.end()
        depth += (token == "(") - (token == ")")
        operand = token == "(" or token in _BINDS
        if not operand and not depth:
            whole = at
    return line[:whole]


def evaluate(postfix: Iterable[str]) -> tuple[frozenset[str], float]:
    """Licences named, and the restriction: or takes the freer side, and the stricter one,
    with (an exception) keeps a part of its left side."""
    stack: list[tuple[frozenset[str], float]] = []
    for token in postfix:
        if token not in _BINDS:
            stack.append((frozenset([token]), restriction(token)))
            continue
        (more, b), (names, a) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((names, a * EXCEPTION_KEEPS))
        else:
            stack.append((names | more, min(a, b) if token == "or" else max(a, b)))
    return stack.pop()


def _automaton(words: Mapping[str, object]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for k, v in words.items():
        a.add_word(k, v)
    a.make_automaton()
    return a


class Scanner:
    """Two automata: tags over the lower-cased text, phrases over its words joined by blanks."""

    def __init__(self, base: Mapping[str, str], notices: Mapping[str, str]):
        self.tags = _automaton({t: t for t in TAGS})
        phrases = {f" {p} ": (p, label, p in base) for p, label in {**notices, **base}.items()}
        self.phrases = _automaton(phrases)

    def scan(self, text: str) -> tuple:
        text = text.encode().lower().decode()  # bytes.lower changes A-Z alone
        words = " ".join(_BREAK.split(text)).strip(" ")
        n_words = words.count(" ") + 1 if words else 0
        line = f" {words} "
        n_base, first, last, seen, at = 0, None, None, 0, 0
        base_labels, labels, score = set(), set(), 0.0
        # ends come in order; a place is counted by the blanks before it
        for end, (phrase, label, is_base) in self.phrases.iter(line):
            labels.add(label)
            if not is_base:
                continue
            start = end - len(phrase)  # the phrase's first letter
            seen += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
            at = start
            word = seen - 1
            n_base += 1
            base_labels.add(label)
            first = word if first is None else min(first, word)
            last = word if last is None else max(last, word)
        score = max((restriction(x) for x in labels), default=0.0)
        for end in dict.fromkeys(end for end, _ in self.tags.iter(text)):  # a tag may end another
            stop = text.find("\n", end)
            expression = leading_expression(text[end + 1 : stop if stop >= 0 else len(text)])
            if expression:
                names, strict = evaluate(to_postfix(expression))
            else:
                names, strict = frozenset([INVALID]), UNKNOWN
            labels |= names
            score = max(score, strict)
        join = lambda x: ",".join(sorted(x))
        return n_words, n_base, first, last, join(base_labels), join(labels), score


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
        ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ]
)


def scan_licenses(
    df: DataFrame,
    base: Mapping[str, str] = BASE_PHRASES,
    notices: Mapping[str, str] = NOTICE_PHRASES,
) -> DataFrame:
    """License findings of every row, without a shuffle.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z
    lower-cased. A place is the index of a base phrase's first word. ``labels`` adds further
    notice phrases and the licences of expressions after a tag (the longest whole expression
    that the rest of the line begins with, so comment ends do no harm; without one,
    ``invalid-expression``). ``score`` is the restriction of the strictest
    finding, 0 without any. A null text is empty: no words, null places, empty labels, score 0.
    A null id stays null, repeated rows give repeated results, an empty table an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices)
        for ids, texts in text_runs(batches):
            found = [scanner.scan(t) for t in texts]
            columns = dict(zip(_SCHEMA.names[1:], zip(*found, strict=True), strict=True))
            yield arrow_rows(_SCHEMA, doc_id=ids, **columns)

    return whole_texts(df).mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double",
    )
