"""The windowed parser against a line-by-line one, at several run lengths."""

import random
import re

import pytest

from tallyhall.functions import fixed_values as fv
from tallyhall.operators.hierarchy import parse_hierarchy


def one_by_one(lines):
    """Plain reading of the rules, one document."""
    skip = re.compile("|".join(fv.SKIP_LINES), re.IGNORECASE)
    path, first, out = {}, None, []
    for no, line in lines:
        if skip.search(line):
            continue
        found = re.match(fv.ENTITY_LINE, line)
        text = re.sub(" {2,}", " ", (found[3] if found else line).strip())
        if not found:
            out[-1][-1] += " " + text
            continue
        first = len(found[1]) if first is None else first
        level = (len(found[1]) - first) // fv.INDENT_STEP
        path = {k: v for k, v in path.items() if k < level} | {level: found[2]}
        out.append([no, *[path.get(k) for k in range(5)], text])
    return sorted(map(tuple, out))


def run(spark, docs, **options):
    rows = [(d, no, line) for d, lines in docs.items() for no, line in lines]
    df = spark.createDataFrame(rows, "doc string, line_no long, line string")
    got = parse_hierarchy(df, **options).collect()
    return {d: sorted(tuple(r)[1:] for r in got if r.doc == d) for d in docs}


def numbered(*lines):
    return list(enumerate(lines))


CASES = {
    "jump": numbered("  10  Top", "            300  Two down", "  11 Back", "     Uniform Codes  Manual",
                     "   a  loose   end", "  and another", "   12   "),
    "skip": numbered("1 Department of Finance", "1 First", "      2 x  Department Of  Finance y", "      3 In"),
    "levels": numbered("0 a", "     1 b", "          2 c", "               3 d", "                    4 e",
                       "          5 f", "     6 g", "tail"),
    "left": numbered("     1 First sets the indent", "          2 below", "   3 left of it", "          4 x"),
}


@pytest.mark.parametrize("chunk", [1, 2, 3, 100_000])
def test_cases(spark, chunk):
    got = run(spark, CASES, chunk_lines=chunk)
    assert {d: one_by_one(lines) for d, lines in CASES.items()} == got


@pytest.mark.parametrize("chunk", [7, 40])
def test_random_documents(spark, chunk):
    rng, docs = random.Random(3), {}
    for d in range(4):
        lines = [(0, "  1 root")]
        for no in range(1, 300):
            kind = rng.random()
            if kind < 0.6:
                lines.append((no, " " * (2 + 5 * rng.randrange(5)) + f"{no}  name {no}"))
            elif kind < 0.9 or 100 < no < 160:
                lines.append((no, f"   more  text {no} "))
            else:
                lines.append((no, rng.choice(["", "  44  ", "REVISED JULY 2020"])))
        docs[f"d{d}"] = lines
    assert {d: one_by_one(lines) for d, lines in docs.items()} == run(spark, docs, chunk_lines=chunk)


def test_errors(spark):
    with pytest.raises(Exception, match="before the first entity"):
        run(spark, {"d": numbered("loose", "1 a")})
    with pytest.raises(Exception, match="out of levels"):
        run(spark, {"d": numbered("1 a", " " * 25 + "2 b")})
