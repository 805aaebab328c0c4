"""An index over classification rules: a multi-pattern automaton finds the few rules that can match a value.

``compile_rules`` tests a value against one rule after the other, up to all of them. Here every rule has a cover:
literals of which one must stand in the value if the rule is to hold (the literal parts of a LIKE pattern, the value of an
equality; of an OR those of all its sides, of an AND those of its most telling side). All covers' literals are keys of
one Aho-Corasick automaton for each input column, so one scan of a value names the candidate rules, however many
rules there are. The candidates are tested in the order of their numbers; the first that holds gives the label.
Rules without a cover (a negation alone) are candidates of every value.

Conditions are tested with SQL's three values: NULL is neither true nor false. The index runs on distinct inputs, which
the caller has added up first (``operators.classify``), in Arrow batches; a task builds it once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from costlake.functions.classify import input_columns

Row = dict[str, str | None]


def flattened(rules, default, given=()) -> list[tuple[tuple, object]]:
    """Rules of rules as one ordered list: a nested rule holds under the conditions around it."""
    out = []
    for cond, label in [*rules, (None, default)]:
        conds = given if cond is None else (*given, cond)
        if isinstance(label, tuple) and label and label[0] == "rules":
            out += flattened(label[1], label[2], conds)
        else:
            out.append((("and", *conds), label))
    return out


def _value(spec, row: Row) -> str | None:
    if isinstance(spec, tuple) and spec[0] == "split_part":
        _, name, delim, n = spec
        text = row[name]
        if text is None:
            return None
        parts = text.split(delim)
        return parts[n - 1] if n <= len(parts) else ""
    if isinstance(spec, tuple):
        text = row[spec[1]]
        return None if text is None else text.lower()
    return row[spec]


@lru_cache(maxsize=None)
def _like(pattern: str) -> re.Pattern:
    return re.compile("".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern), re.DOTALL)


def holds(cond, row: Row) -> bool | None:
    """A condition's truth for a row; None where SQL says NULL."""
    op = cond[0]
    if op == "not":
        inner = holds(cond[1], row)
        return None if inner is None else not inner
    if op in ("and", "or"):
        end, unknown = op == "or", False
        for c in cond[1:]:
            found = holds(c, row)
            if found is end:
                return end
            unknown |= found is None
        return None if unknown else not end
    value = _value(cond[1], row)
    if value is None:
        return None
    if op == "like":
        return _like(cond[2]).fullmatch(value) is not None
    if op == "rlike":
        return re.search(cond[2], value) is not None
    return value == cond[2] if op == "eq" else value in cond[2]


def label_of(label, row: Row) -> str | None:
    if isinstance(label, tuple) and label[0] == "col":
        return row[label[1]]
    if isinstance(label, tuple) and label[0] == "concat":
        parts = [label_of(x, row) for x in label[1:]]
        return None if None in parts else "".join(parts)
    return label


def covers(cond) -> list[frozenset[tuple[str, str]]]:
    """Sets of (column, literal), of each of which one must be in the row if the condition holds."""
    op = cond[0]
    if op in ("like", "eq", "in"):
        spec = cond[1]
        if isinstance(spec, tuple) and spec[0] == "lower":
            return []  # the column's own letters may be of either case
        name = spec[1] if isinstance(spec, tuple) else spec
        if op == "like":
            parts = [p for p in re.split("[%_]", cond[2]) if p]
            return [frozenset([(name, p)]) for p in parts]
        values = [cond[2]] if op == "eq" else list(cond[2])
        return [frozenset((name, v) for v in values)] if all(values) else []
    if op == "and":
        return [s for c in cond[1:] for s in covers(c)]
    if op == "or":
        # one literal set of each side; a side without any leaves the whole without
        sides = [covers(c) for c in cond[1:]]
        return [frozenset().union(*[max(s, key=_telling) for s in sides])] if all(sides) else []
    return []


def _telling(cover: frozenset[tuple[str, str]]) -> tuple:
    return min(len(text) for _, text in cover), -len(cover)


class RuleIndex:
    """Ordered rules, and for each input column an automaton over the literals of the rules' covers."""

    def __init__(self, rules, default) -> None:
        self.rules = flattened(rules, default)
        self.inputs = input_columns(rules, default)
        choices = [covers(cond) for cond, _ in self.rules]
        common = Counter(literal for sets in choices for s in sets for literal in s)
        found: dict[str, dict[str, list[int]]] = {}
        self.always = []
        for n, sets in enumerate(choices):
            if not sets:
                self.always.append(n)
                continue
            # the cover that the fewest rules share
            for name, text in min(sets, key=lambda s: (sum(common[x] for x in s), *(-t for t in _telling(s)))):
                found.setdefault(name, {}).setdefault(text, []).append(n)
        self.automata = {}
        for name, literals in found.items():
            self.automata[name] = ahocorasick.Automaton()
            for text, numbers in literals.items():
                self.automata[name].add_word(text, numbers)
            self.automata[name].make_automaton()

    def candidates(self, row: Row) -> list[int]:
        """Numbers of the rules that may hold, in order."""
        found = set(self.always)
        for name, automaton in self.automata.items():
            if row[name]:
                for _, numbers in automaton.iter(row[name]):
                    found.update(numbers)
        return sorted(found)

    def match(self, row: Row) -> tuple[int, str | None]:
        """Number and label of the first rule that holds; the last rule, the default, always does."""
        for n in self.candidates(row):
            if holds(self.rules[n][0], row):
                return n, label_of(self.rules[n][1], row)
        raise AssertionError("the default holds for every row")


def _labels(make, inputs: list[str], out_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RuleIndex(*make())
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in inputs]
            labels = [index.match(dict(zip(inputs, values, strict=True)))[1] for values in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(labels, pa.string())], names=[*batch.schema.names, out_col])

    return run


def with_labels(df: DataFrame, make, out_col: str) -> DataFrame:
    """df with the label of the first rule that holds. ``make``: a function of a module that returns rules and default."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields] + [T.StructField(out_col, T.StringType())])
    return df.mapInArrow(_labels(make, input_columns(*make()), out_col), schema)
