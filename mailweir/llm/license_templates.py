"""License scans by template-markup matching.

A template is license wording with marked regions, in the markup of the public license
list: ``<<beginOptional>> .. <<endOptional>>`` may be missing as a whole, and
``<<var;match="REGEX";words="0..3">>`` stands for so many words, each matching the
expression. It is compiled to an automaton over words: a chain for the wording, a way
around each optional region, a counted run for each variable one. A text is accepted
where some stretch of its words leads from the start to the end, which takes every
mandatory word, in order and unchanged.

The automaton starts only where the template's first words stand; its sets of states are
remembered, so reading a word is one look-up.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweir.llm.common import plain_words, table

# Phrases and the labels they give wherever they stand.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

_OR_LATER = (
    "<<beginOptional>>as published by the free software foundation<<endOptional>> "
    "<<beginOptional>>either<<endOptional>> version {0} <<beginOptional>>0<<endOptional>> "
)
_HOLDER = '<<var;match=".+";words="1..10">>'
_NUMBER = '<<var;match="[0-9a-d]";words="0..1">> '
_NO_ENDORSEMENT = (
    _NUMBER + "Neither the name of " + _HOLDER + " nor the names of " + _HOLDER + " may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_ADVERTISING = (
    _NUMBER + "All advertising materials mentioning features or use of this software must display the following "
    "acknowledgement: This product includes software developed by " + _HOLDER + ". "
)
# The place is for the clauses after the second.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: " + _NUMBER + "Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. " + _NUMBER + "Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    'materials provided with the distribution. {}THIS SOFTWARE IS PROVIDED BY ' + _HOLDER + ' "AS IS" AND ANY EXPRESS OR '
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL " + _HOLDER + " BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
# Public license wording with its optional and replaceable regions.
TEMPLATES = (
    ("gpl-2.0", "licensed under the GNU General Public License, " + _OR_LATER.format(2)),
    ("gpl-3.0", "licensed under the GNU General Public License, " + _OR_LATER.format(3)),
    ("gpl-3.0", "under the terms of the GNU General Public License " + _OR_LATER.format(3)),
    ("apache-2.0", "licensed under the Apache License, Version 2.0"),
    ("cc-by-4.0", 'licensed under <<beginOptional>>a Creative Commons Attribution<<endOptional>> CC BY '
     '<<beginOptional>>version<<endOptional>> 4.0'),
    ("cc-by-nc-4.0", 'licensed under <<beginOptional>>a Creative Commons Attribution NonCommercial'
     '<<endOptional>> CC BY-NC <<beginOptional>>version<<endOptional>> 4.0'),
    ("cc-by-sa-4.0", 'licensed under <<beginOptional>>a Creative Commons Attribution ShareAlike'
     '<<endOptional>> CC BY-SA <<beginOptional>>version<<endOptional>> 4.0'),
    ("mit-notice", 'released under the <<var;match="[a-z]+";words="0..1">> MIT License'),
    ("mit-notice", 'licensed under the <<var;match="[a-z]+";words="0..1">> MIT License'),
    ("mit-text", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this '
     'software and associated documentation files (the "Software"), to deal in <<var;match=".+";words="1..2">> '
     'without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
     'distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is '
     'furnished to do so, subject to the following conditions: The above copyright notice and this permission notice '
     '<<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial '
     'portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
     'INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND '
     '<<var;match="non|infringement|noninfringement";words="1..2">>. IN NO EVENT SHALL ' + _HOLDER + ' BE LIABLE FOR ANY '
     'CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR '
     'IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("bsd-2-clause", _BSD.format("")),
    ("bsd-3-clause", _BSD.format(_NO_ENDORSEMENT)),
    ("bsd-4-clause", _BSD.format(_ADVERTISING + _NO_ENDORSEMENT)),
    ("isc-text", 'Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this '
     'software for any purpose with or without fee is hereby granted, provided that the above copyright '
     'notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND ' + _HOLDER +
     ' DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND '
     'FITNESS. IN NO EVENT SHALL ' + _HOLDER + ' BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES '
     'OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, '
     'NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
)

_MARK = re.compile(r'<<beginOptional>>|<<endOptional>>|<<var;match="([^"]*)";words="(\d+)\.\.(\d+)">>')
#: Sets of states an automaton remembers steps for.
STEPS = 100_000


class Template:
    """One template, compiled."""

    def __init__(self, label: str, markup: str):
        self.label = label
        #: Of each state: ways without a word, and (word or expression, next state).
        self.free: list[list[int]] = [[]]
        self.ways: list[list[tuple[bytes | re.Pattern, int]]] = [[]]
        opened: list[int] = []
        at, leading = 0, True
        anchor: list[bytes] = []
        for mark in (*_MARK.finditer(markup), None):
            literal = plain_words(markup[at : mark.start() if mark else len(markup)])
            anchor += literal if leading else []
            for word in literal:
                self._way(word)
            if mark is None:
                break
            leading, at = False, mark.end()
            if mark[0] == "<<beginOptional>>":
                opened.append(self._last())
            elif mark[0] == "<<endOptional>>":
                self._skip(opened.pop())
            else:
                word = re.compile(mark[1].encode())
                least, most = int(mark[2]), int(mark[3])
                for k in range(most):
                    before = self._last()
                    self._way(word)
                    if k >= least:
                        opened.append(before)
                for _ in range(most - least):
                    self._skip(opened.pop())
        if not anchor or opened:
            raise ValueError(f"{label}: a template begins with plain words and closes its regions")
        self.anchor = b" " + b" ".join(anchor) + b" "
        self.end = self._last()
        self.steps: dict[tuple[frozenset, bytes], frozenset] = {}

    def _last(self) -> int:
        return len(self.free) - 1

    def _way(self, word: bytes | re.Pattern) -> None:
        self.free.append([])
        self.ways.append([])
        self.ways[self._last() - 1].append((word, self._last()))

    def _skip(self, start: int) -> None:
        # A state of its own, so that regions ending or starting here don't mix.
        self.free.append([])
        self.ways.append([])
        self.free[self._last() - 1].append(self._last())
        self.free[start].append(self._last())

    def _reach(self, states: set[int]) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for state in self.free[todo.pop()]:
                if state not in seen:
                    seen.add(state)
                    todo.append(state)
        return frozenset(seen)

    def _step(self, states: frozenset, word: bytes) -> frozenset:
        key = (states, word)
        after = self.steps.get(key)
        if after is None:
            if len(self.steps) >= STEPS:
                self.steps.clear()
            after = self.steps[key] = self._reach({
                to for s in states for w, to in self.ways[s]
                if (w == word if isinstance(w, bytes) else w.fullmatch(word))
            })
        return after

    def found(self, words: Sequence[bytes], starts: Iterable[int]) -> bool:
        """Whether the template's text begins at one of the ascending ``starts``.

        All starts are followed in one pass, as one set of states, so a word is looked at once
        however many starts lie before it. A number at the end is whole: no other number follows.
        """
        begin, none = self._reach({0}), frozenset()
        coming = iter(starts)
        start = next(coming, None)
        at, states = start, none
        while at is not None and at < len(words):
            if at == start:
                states |= begin
                start = next(coming, None)
            word = words[at]
            states = self._step(states, word)
            at += 1
            if self.end in states and not (word.isdigit() and at < len(words) and words[at].isdigit()):
                return True
            if not states:
                at = start
        return False

    def accepts(self, words: Sequence[bytes]) -> bool:
        """Whether a prefix of ``words`` is the template's text."""
        return self.found(words, [0])


def places(text: bytes, phrase: bytes) -> Iterator[int]:
    """Word numbers at which ``phrase`` stands; both are words between single spaces."""
    at, word, seen = text.find(phrase), 0, 0
    while at >= 0:
        word += text.count(b" ", seen, at)
        seen = at
        yield word
        at = text.find(phrase, at + 1)


@cache
def _compiled(templates: tuple[tuple[str, str], ...]) -> tuple[Template, ...]:
    return tuple(Template(label, markup) for label, markup in templates)


def scan_words(words: list[bytes], phrases: Sequence[tuple[str, str]], templates: Sequence[Template]) -> dict:
    text = b" " + b" ".join(words) + b" "
    starts, base = [], set()
    for phrase, label in phrases:
        found = list(places(text, b" " + phrase.encode() + b" "))
        if found:
            base.add(label)
            starts += found
    own = set()
    for template in templates:
        if template.label not in own and template.found(words, places(text, template.anchor)):
            own.add(template.label)
    return {
        "n_words": len(words),
        "n_base": len(starts),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | own)),
        "score": 1.0 if own else 0.5 if base else 0.0,
    }


_FOUND = pa.schema([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
])


def scan(
    docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Phrases and licenses in each text.

    One row per input row: ``doc_id``, the counts, first and last word of the phrases, their
    labels, ``labels`` with those of the accepted templates, and a score: 1 if a template
    accepts, 0.5 if only a phrase stands there, else 0. A NULL or empty text has no words;
    a NULL ``doc_id`` and repeated rows stay; an empty table gives no rows. Other columns are
    not looked at. Nothing is shuffled.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    phrases, templates = tuple(phrases), tuple(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = _compiled(templates)
        for batch in batches:
            found = [scan_words(plain_words(v.as_py()), phrases, compiled) for v in batch.column("text")]
            columns = [pa.array([f[c.name] for f in found], c.type) for c in _FOUND]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], names=["doc_id", *_FOUND.names]
            )

    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double",
    )


def op9_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


QUERIES = {"op9_license_templates": op9_license_templates}
ORACLE: dict[str, str] = {}
