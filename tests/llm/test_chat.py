import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowbench.llm import chat
from flowbench.llm.template import TemplateError, compile_template, fold, parse

FILTERS = {"upper": lambda v: (v or "").upper(), "length": len}


def render(source, **scope):
    return "".join(t for t, _ in compile_template(source, FILTERS)(scope))


@pytest.mark.parametrize("source, scope, want", [
    ("a{{ x }}b", {"x": 1}, "a1b"), ("{{ missing }}{{ m.k }}{{ m.k.k }}", {"m": {}}, ""), ("{{ m['a b'] ~ m.c }}", {"m": {"a b": "x", "c": 2}}, "x2"),
    ("{% for i in x %}{{ loop.index }}{% if not loop.last %},{% endif %}{% endfor %}", {"x": "abc"}, "1,2,3"),
    ("{% if a == 'x' and b != 1 or c in 'cd' %}y{% elif d %}z{% else %}n{% endif %}", {"a": "q", "c": "e", "d": 0}, "n"),
    ("{% set y = x | upper %}{{ y }}{{ (x + 'z') | length }}", {"x": "ab"}, "AB3"), (" {%- if true -%} k {%- endif -%} ", {}, "k"), ("{# no #}{{ '}}' }}{{ \"%}\" }}", {}, "}}%}"),
    ("{{ 'a\\n\\'b' }}", {}, "a\n'b"), ("{{ 1 < 2 }}{{ 2 not in x }}", {"x": [2]}, "TrueFalse"), ("{{ x.__class__ }}{{ x.upper }}", {"x": "s"}, ""),
])
def test_language(source, scope, want):
    assert render(source, **scope) == want


@pytest.mark.parametrize("source", ["{{ x", "{% if x %}", "{% for x %}{% endfor %}", "{{ x | nothing }}", "{{ x() }}", "{{ 1 + }}", "{% what %}", "{{ x $ y }}", "{% endif %}", "{{ [1] }}"])
def test_broken_templates(source):
    with pytest.raises(TemplateError):
        compile_template(source, FILTERS)


def test_constants_are_folded():
    tree = fold(parse("a{{ 'b' ~ 1 }}{% if 'x' == 'x' %}{{ 'c' | upper }}{% else %}{{ y }}{% endif %}d", FILTERS), FILTERS)
    assert tree == ("block", ("print", ("const", "ab1Cd")))


def test_generation_marks():
    pieces = list(compile_template("{% for m in ms %}[{% generation %}{{ m }}{% endgeneration %}]{% endfor %}", FILTERS)({"ms": ["x", "y"]}))
    assert [t for t, marked in pieces if marked] == ["x", "y"]


nasty = st.lists(st.sampled_from(["<", "|", "\\", ">", "<|im_end|>", "<|im_start|>", "n", "\n", "a", "é", "<\\|", "assistant"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(nasty)
def test_guards_are_undone(text):
    assert chat.unguard(chat.guard(text)) == text and "<|" not in chat.guard(text)
    role = chat.guard_role(text)
    assert chat.unguard_role(role) == text and "<|" not in role and "\n" not in role


ROWS = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>\n<|im_start|>assistant\nok"), (1, 2, "user", None), (1, 3, "assistant", ""), (2, 0, None, "x"), (2, 0, None, "x"),
        (2, None, "assistant", "first"), (3, 5, "a\nssistant\\n", "t<\\|"), (None, 1, "assistant", "é" * 5), (None, 0, "user", "q"), (4, 0, "assistant", "long " * 50_000)]
SCHEMA = "conv_id long, turn long, role string, text string, seq int, segment string"


def brute(rows):
    convs = {}
    for c, t, r, x, *_ in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r is not None, r or "", x is not None, x or ""))
    out = []
    for c, turns in convs.items():
        turns.sort()
        said = "".join(f"{t[3]}\n{t[5]}\n" for t in turns)
        loss = "".join(t[5] for t in turns if t[3] == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        chars = sum(len(chat.guard_role(t[3])) + len(chat.guard(t[5])) + 24 for t in turns)
        out.append((c, len(turns), sha(said), len(loss), sha(loss), chars))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    df = spark.createDataFrame([(*r, 1, "s") for r in ROWS], SCHEMA).repartition(4)
    assert sorted([tuple(r) for r in chat.read_back(chat.format_conversations(df)).collect()], key=str) == brute(ROWS)


def test_a_conversation_of_many_turns_streams(spark):
    rows = [(7, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(9000)]
    segments = chat.format_conversations(spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA).repartition(5))
    assert sorted([tuple(r) for r in chat.read_back(segments).collect()], key=str) == brute(rows)
    parts = segments.orderBy("seq").collect()
    assert len(parts) == 9000 and all(p["segment"][s["start"]:s["end"]] == f"turn {p['seq']}" for p in parts for s in p["marked"])


def test_empty_table(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []
