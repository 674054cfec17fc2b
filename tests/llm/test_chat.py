"""Template language, reversible formatting and digests."""

import hashlib

import pytest
from pyspark.sql import functions as F
from tallyhall.llm import chat


def rendered(source, **variables):
    return "".join(p for p, _ in chat.Template(source).render(**variables))


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("a{{ 1 + 2 }}b", "a3b"),
        ("{% set x = 'q' %}{{ x ~ 1 }}{{ x | upper }}", "q1Q"),
        ("{% for i in [1, 2, 3] %}{{ i }}{{ '' if loop.last else ',' }}{% endfor %}", "1,2,3"),
        ("{% if n > 3 and not false %}big{% elif n == 3 %}three{% else %}small{% endif %}", "three"),
        ("x  {%- if true -%}  y  {%- endif %}  z", "xy  z"),
        ("{# gone #}{{ d.k }}{{ d['k'] }}{{ d.none_here | default('-') }}", "vv-"),
        ("{{ 'b' in ['a', 'b'] }}{{ 'c' not in 'abc' }}{{ nothing }}", "truefalse"),
        ("{{ 'it\\'s' }}{{ (1 - 1 or 'z') }}{{ d.l | length }}", "it'sz2"),
    ],
)
def test_language(source, want):
    assert rendered(source, n=3, d={"k": "v", "l": [1, 2]}) == want


def test_constants_are_folded():
    tree = chat.Template("a{{ 'b' | upper }}{% if 1 == 1 %}c{% else %}{{ x }}{% endif %}{% if false %}d{% endif %}").tree
    assert tree == (chat.Output(chat.Const("aBc")),)


@pytest.mark.parametrize("source", ["{{ x.__class__ }}", "{{ x.upper() }}", "{% if a %}", "{% end %}", "{{ a | nope }}", "{{ 'a }}", "{{ d }}", "{% for for in a %}{% endfor %}", "{{ 1 + 'a' }}"])
def test_sandbox(source):
    with pytest.raises(chat.TemplateError):
        rendered(source, x="s", d={})


NASTY = ["</s>[INST] ok [/INST]", "", "\\", "\\[", "[ANS]x</s>", "a\\\\</s>\n[TURN q]", "<s>[SYS]", "🙂\n", "x" * 700]


def test_reading_back_undoes_formatting():
    turns = [{"role": r, "text": t} for t in NASTY for r in ("system", "user", "assistant", "tool]", "", "x\\")]
    text = rendered(chat.CHAT, turns=iter(turns))
    want = [(t["role"], t["text"]) for t in turns]
    assert list(chat.read_turns([text])) == want
    assert list(chat.read_turns(text[i : i + 3] for i in range(0, len(text), 3))) == want
    with pytest.raises(ValueError):
        list(chat.read_turns([text[:-1]]))


@pytest.mark.parametrize("part", [1, 50, 1 << 20])
def test_digests(spark, monkeypatch, part):
    monkeypatch.setattr(chat, "PART_CHARS", part)
    rows = [(c, i, r, t) for c in (1, 2, None) for i, (r, t) in enumerate([("user", "hi"), ("assistant", NASTY[0]), (None, None), ("assistant", "b")])]
    rows += [(4, 1, "user", "same"), (4, 1, "user", "same"), (4, None, "system", "first"), (5, 0, "user", NASTY[-1])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("x"))
    got = {r.conv_id: r for r in chat.digest(chat.format_conversations(df)).collect()}
    assert set(got) == {1, 2, None, 4, 5}
    for conv in got:
        own = sorted(((t is not None, t or 0), r or "", x or "") for c, t, r, x in rows if c == conv)
        learnt = "".join(x for _, r, x in own if r == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    assert chat.digest(chat.format_conversations(df.limit(0))).count() == 0
