import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vexa.llm import chat
from vexa.llm.queries import HARD_TEXT

CONV = "conv_id long, turn long, role string, text string, segment string, loss string, n_turns string"


def rendered(source, controls=(), **variables):
    return "".join(chat.compile_template(source, controls).render(variables.pop("messages", []), **variables).parts)


@pytest.mark.parametrize("source, want", [
    ("{{ 'a' ~ 1 + 2 }}", "a12"), ("{{ 1 + 2 }}", "3"), ("{{ x.y[0].z }}", "deep"), ("{{ x.nothing.at.all }}", ""),
    ("{% if n > 2 and not n == 4 %}big{% elif n == 2 %}two{% else %}small{% endif %}", "big"),
    ("{% for i in l %}{{ loop.index }}{{ i }}{% if not loop.last %},{% endif %}{% endfor %}", "1p,2q"),
    ("{% set k = 'v' | upper %}{{ k }}{# gone #}", "V"), ("a  {{- ' b ' | trim -}}  c", "abc"),
    ("{{ 'yes' if 'e' in 'hey' else 'no' }}", "yes"), ("{{ l | length }}{{ 5 not in l }}", "2true"),
    ("{{ 'q\\'' }}{{ \"\\n\" }}", "q'\n"), ("{{ true }}{{ none }}{{ 'a' < 1 }}", "truefalse"),
])
def test_expressions_and_statements(source, want):
    assert rendered(source, x={"y": [{"z": "deep"}]}, n=3, l=["p", "q"]) == want


@pytest.mark.parametrize("source", ["{{ f() }}", "{{ x | no_such }}", "{% if x %}", "{% endif %}", "{{ }}", "{{ 1 + }}", "{% import os %}",
                                    "{{ 'open }}", "{% for x %}{% endfor %}", "{{ a b }}", "{{ and }}"])
def test_what_is_not_in_the_language_is_an_error(source):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(source)


def test_sandbox_sees_no_python_attributes():
    assert rendered("{{ x.__class__ }}{{ m.keys }}{{ s.upper }}{{ s['__len__'] }}", x=[], m={}, s="t") == ""
    with pytest.raises(chat.TemplateError):
        rendered("{{ m }}", m={"a": 1})


def test_constants_are_folded():
    t = chat.compile_template("a{{ 'b' | upper }}{% if 1 == 2 %}x{% else %}{{ 2 + 3 }}{% endif %}c{{ 'k' if false else y }}")
    assert t.tree == (chat.Text("aB5c"), chat.Emit(chat.Name("y")))


def test_generation_marks_do_not_nest():
    out = chat.compile_template("a{% generation %}b{% generation %}c{% endgeneration %}{% endgeneration %}d").render([])
    assert "".join(out.parts) == "abcd" and out.spans == [(1, 3)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="\\ab<>/#: ", max_size=30))
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    controls = ("aa", "<a>", "</a>", "# ", "ab", "aba")
    e = chat.Escaper(controls)
    done = e.escape(text)
    assert e.unescape(done) == text and not any(c in done for c in controls)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="u#: <text>\\", max_size=12), st.text(alphabet="</turn>\n# :text\\é\U0001f600", max_size=40)), max_size=5))
def test_reader_restores_turns_and_mask(turns):
    turns = [("assistant" if len(r) % 2 else r, t) for r, t in turns]
    out = chat.compile_template(chat.TEMPLATE, chat.CONTROLS).render([{"role": r, "text": t} for r, t in turns])
    text, reader = "".join(out.parts), chat.Reader()
    assert list(reader.turns(text)) == turns
    assert [reader.unescape(text[a:z]) for a, z in out.spans] == [t for r, t in turns if r == "assistant"]


def test_segments_equal_the_whole():
    source = "<{{ bos }}>{% for m in messages %}{{ loop.index }}{{ loop.first }}{{ loop.last }}{{ loop.length }}{{ m.text }};{% endfor %}end"
    t = chat.compile_template(source)
    messages = [{"text": str(i)} for i in range(7)]
    whole = "".join(t.render(messages, bos="s").parts)
    cut = "".join("".join(t.render_segment(messages[i:i + 3], i, 7, bos="s").parts) for i in (0, 3, 6))
    assert t.by_turn and whole == cut
    for other in ("{{ messages[0].text }}{% for m in messages %}{% endfor %}", "{% for m in messages %}{{ messages | length }}{% endfor %}",
                  "{% set a = 1 %}{% for m in messages %}{% endfor %}", "plain"):
        assert not chat.compile_template(other).by_turn


def report(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "s", "l", "n") for r in rows], CONV)
    got = chat.read_back(chat.format_conversations(df, **kw)).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r)[1:] for r in got}


def brute(rows):
    def key(r):
        return (r[1] is None, r[1] or 0, *(hashlib.md5((x or "").encode()).hexdigest() for x in r[2:]))
    out = {}
    for c in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=key)]
        said = "".join(t for r, t in turns if r == "assistant")
        e = chat.Escaper(chat.CONTROLS).escape
        size = sum(len(e(r)) + len(e(t)) + len("### :<text></turn>\n") for r, t in turns)
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(said),
                  hashlib.sha256(said.encode()).hexdigest(), size)
    return out


def conversations():
    rows = [(c, t, "assistant" if t % 2 else "user", f"{c} says \\ {'</turn>' * (t % 3)} é😀 {t}") for c in range(6) for t in range(2 + 5 * c)]
    rows += [(-7, 0, "user", HARD_TEXT), (-7, 1, "assistant", HARD_TEXT), (50, None, None, None), (50, 1, "assistant", None),
             (50, 1, "assistant", ""), (None, 3, "assistant", "no id"), (None, 1, "user", "none"), (51, 2, "x", "tie b"), (51, 2, "x", "tie a"),
             (51, 2, "x", "tie a"), (52, 0, "assistant", "long " * 200_000 + "</turn>")]
    return rows[::-1]


@pytest.mark.parametrize("kw", [{}, {"long_turns": 3, "segment_turns": 2}, {"long_bytes": 100, "segment_turns": 5}])
def test_formatting_equals_brute_force_whole_and_in_segments(spark, kw):
    rows = conversations()
    assert report(spark, rows, **kw) == brute(rows)


def test_long_conversations_and_templates_that_need_them_whole(spark):
    df = spark.createDataFrame([r + ("", "", "") for r in conversations()], CONV)
    with pytest.raises(chat.TemplateError):
        chat.format_conversations(df, "{{ messages | length }}", (), long_turns=3)
    parts = chat.format_conversations(df, long_turns=10, segment_turns=4).filter("segments > 1").collect()
    assert {p.conv_id for p in parts} == {2, 3, 4, 5} and max(len(p.loss) for p in parts) <= 4


def test_no_conversations(spark):
    assert report(spark, []) == {}
