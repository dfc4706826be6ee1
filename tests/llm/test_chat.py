"""Template language, constant folding, and reading formatted conversations back."""

import hashlib

import pytest

from shelfline.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize(("source", "variables", "text"), [
    ("a{{ 'b' ~ 1 + 2 }}c", {}, None),
    ("{{ x | default('none') }}", {}, "none"),
    ("{% for m in ms %}{{ loop.index }}{{ m.a }}{% if not loop.last %},{% endif %}{% endfor %}",
     {"ms": [{"a": "x"}, {"a": "y"}]}, "1x,2y"),
    ("{% if a == 1 %}one{% elif a == 2 %}two{% else %}more{% endif %}", {"a": 2}, "two"),
    ("{% set y = x | upper %}{{ y ~ '!' }}", {"x": "hi"}, "HI!"),
    ("a {#- note -#} b", {}, "ab"),
    ("x  {%- if true %} y {%- endif %}", {}, "x y"),
    ("{{ 'a' if b is defined else 'z' }}{{ d['k'][0] }}", {"d": {"k": ["q"]}}, "zq"),
    ("{{ 'x' in 'xyz' and not 1 > 2 }}", {}, "true"),
    ("{{ s | replace('a', 'b') | length }}", {"s": "aaa"}, "3"),
])
def test_language(source, variables, text):
    if text is None:
        with pytest.raises(TypeError):
            chat.Template(source)
    else:
        assert chat.Template(source).render(**variables)[0] == text


def test_constants_are_folded():
    assert chat.Template("a{{ 'b' ~ 'c' }}{% if 1 > 2 %}no{% else %}d{% endif %}e").tree == ("block", ("text", "abcde"))
    assert chat.Template("{% if false and x %}no{% endif %}").tree == ("block",)


@pytest.mark.parametrize("source", ["{{ x.__class__ }}", "{{ f() }}", "{{ x | eval }}", "{% for x %}{% endfor %}",
                                    "{% if x %}", "{{ 1 + }}", "{% import os %}", "{{ _x }}"])
def test_sandbox_refuses(source):
    with pytest.raises(chat.TemplateError):
        chat.Template(source).render(x="a")


def test_members_are_data_only():
    assert chat.Template("{{ x.upper }}{{ x.format }}").render(x="a")[0] == ""
    with pytest.raises(chat.TemplateError):
        chat.Template("{{ x }}").render(x=[1])


@pytest.mark.parametrize("text", ["", "\\", "<s>", "</s>[INST] ok [/INST]", "<\\s>", "\\\\<s>\\", "[[INST]]", "<</s>", "[/INST",
                                  "a\nb", "<s", "日本<s>語"])
def test_escape_is_reversible(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROLS)


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


ROWS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "hi </s> there"), (1, 2, None, None), (1, 2, None, None),
    (None, None, "user", "[INST]"), (None, 0, "assistant", "a\\"), (2, 5, "<s>", ""), (3, 1, "assistant", ""),
    (4, 0, "user", "x" * 5000), (4, 1, "assistant", "\\<s>" * 3000), (4, 2, "assistant", "ü</s>" * 2000),
]


@pytest.mark.parametrize("part_chars", [chat.PART_CHARS, 997])
def test_round_trip(frame, part_chars):
    formatted = chat.format_conversations(frame(ROWS, SCHEMA), part_chars=part_chars)
    found = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    assert set(found) == {1, 2, 3, 4, None}
    for conv, r in found.items():
        own = sorted((x for x in ROWS if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        loss = [x[3] or "" for x in own if x[2] == "assistant"]
        assert r.n_turns == len(own)
        assert r.turns_sha256 == digest(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        assert r.loss_chars == len("".join(loss))
        assert r.loss_sha256 == digest(loss)
    sizes = {}
    for r in formatted.collect():
        assert len(r.formatted) <= part_chars
        sizes[r.conv_id] = sizes.get(r.conv_id, 0) + len(r.formatted)
    assert sizes == {k: r.formatted_chars for k, r in found.items()}


def test_empty_table(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
