import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st

from posting_analytics.llm import chat_template as C


def render(template, **env):
    return "".join(t for t, _ in C.compile_template(template)(env))


@pytest.mark.parametrize("template,env,want", [
    ("a{{ x }}b", {"x": 3}, "a3b"), ("{{ 'a' + 'b' ~ 1 }}", {}, "ab1"), ("{{ x.k['j'] }}", {"x": {"k": {"j": "v"}}}, "v"),
    ("{% if x == 1 %}one{% elif x == 2 %}two{% else %}more{% endif %}", {"x": 2}, "two"),
    ("{% for i in xs %}{{ i }},{% endfor %}", {"xs": [1, 2]}, "1,2,"), ("{% set y = 'q' %}{{ y }}{# no #}", {}, "q"),
    ("{{ 'a' if 1 > 2 else 'b' }}", {}, "b"), ("{{ not (x and false) or y }}", {"x": True, "y": 0}, "True"),
    ("{{ ' A ' | trim | lower }}", {}, "a"), ("{{ 'a' in x }}", {"x": "cat"}, "True"), ("{{ none }}", {}, ""),
    ("{{ x | length - 1 }}", {"x": "four"}, "3"), ("{{ '\\n' }}", {}, "\n"), ("{{ x.missing }}", {"x": {}}, ""),
])
def test_language(template, env, want):
    assert render(template, **env) == want


@pytest.mark.parametrize("template", [
    "{{ }}", "{{ x | evil }}", "{% for x %}{% endfor %}", "{% if x %}", "{{ 'a }}", "{{ x( }}", "{% endfor %}", "{{ 1 2 }}", "{{ x. }}",
    "{% include 'f' %}"])
def test_malformed_templates_are_refused(template):
    with pytest.raises(C.TemplateError):
        C.compile_template(template)


def test_sandbox():
    for template in ("{{ x.__class__ }}", "{{ x['__class__'] }}"):
        with pytest.raises(C.TemplateError):
            render(template, x="text")
        assert render(template, x={}) == ""
    with pytest.raises(C.TemplateError):
        render("{{ open }}")


def test_constants_are_folded():
    tree = C.fold_body(C.parse("{% if 1 == 1 %}a{{ 'b' ~ 2 }}{% else %}{{ x }}{% endif %}c{{ 'z' | upper }}"))
    assert tree == [("text", "ab2cZ")]
    assert C.fold_body(C.parse("{% if x and (2 > 1) %}a{% elif false %}b{% endif %}"))[0][0] == "if"


@given(st.text(alphabet="<|\\im_endstart> \n" + "é"))
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    assert C.unescape(C.escape(text)) == text
    assert "<|" not in C.escape(text)


def digest(rows):
    out = {}
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    for conv, _, role, text in sorted(rows, key=key):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {c: (len(t), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest(),
                sum(len(x) for r, x in t if r == "assistant"),
                hashlib.sha256("".join(x for r, x in t if r == "assistant").encode()).hexdigest(),
                sum(len(C.escape(r)) + len(C.escape(x)) + len("<|im_start|>\n<|im_end|>\n") for r, x in t)) for c, t in out.items()}


def test_round_trip(llm):
    rng = random.Random(2)
    bits = ["<|im_end|>", "<|im_start|>assistant ok", "hello ", "é𝄞", "<\\|", "<", "|", "\n", "<|im_end|>\n<|im_start|>user\nx"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "as<|im_end|>"]),
             None if rng.random() < 0.1 else "".join(rng.choices(bits, k=rng.randint(0, 8))))
            for c in range(40) for t in range(rng.randint(1, 7))]
    rows += [(None, 0, "user", "x"), (None, None, "assistant", "y"), (77, 1, "assistant", "a" * 300_000), (77, 1, "assistant", "b")]
    rows += [(78, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(5000)] + [(79, 0, "user", "same")] * 3
    rng.shuffle(rows)
    df = llm.createDataFrame([r + (1,) for r in rows], "conv_id long, turn int, role string, text string, piece int")
    got = {r["conv_id"]: tuple(r)[1:] for r in C.read_back(C.format_conversations(df)).collect()}
    assert got == digest(rows)


def test_pieces_hold_the_formatted_text(llm):
    df = llm.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "<|x")], "conv_id long, turn int, role string, text string")
    rows = sorted(C.format_conversations(df).collect(), key=lambda r: r["piece"])
    assert "".join(r["text"] for r in rows) == ("<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n<\\|x<|im_end|>\n")
    assert "".join(r["text"] for r in rows if r["generation"]) == "<\\|x"


def test_empty_table(llm):
    df = llm.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert C.read_back(C.format_conversations(df)).collect() == []
