"""Operator 10 renders by the same rules at any depth."""

import pytest

from accordion.llm import html_text


@pytest.mark.parametrize("tag", ["div", "span", "font"])
@pytest.mark.parametrize("depth", [0, 198, 199, 200, 201, 2000])
@pytest.mark.parametrize(
    "inner, text",
    [
        ("<div>a</div><div>b</div>", "a\nb"),
        ("<table><tr><td>1<td>2<tr><td>33<td>4</table>", "1   2\n33  4"),
        ("a<br>b", "a\nb"),
        ("<ul><li>a<li>b</ul>", "- a\n- b"),
        ("<pre>  a\n b</pre>", "  a\n b"),
        ('<img alt="A">', "A"),
        ("<p>a<p>b", "a\n\nb"),
    ],
)
def test_depth_does_not_matter(tag, depth, inner, text):
    assert html_text.Page(f"<{tag}>" * depth + inner).text == text


def test_deep_lists_and_tables():
    page = html_text.Page("<ul><li>" * 300 + "x")
    assert page.text == "- " * 300 + "x" and page.items == 300
    page = html_text.Page("<table><tr><td>" * 300 + "<div>a</div><div>b</div>")
    assert page.text == "a\nb" and page.cells == 300


@pytest.mark.parametrize(
    "page, text",
    [
        ("a <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>tex</annotation></math> b", "a x=1 b"),
        ("a<svg><title>t</title><defs><text>d</text></defs><path d='M0'/><text>b <tspan>c</tspan></text><text>d</text></svg>e", "a b c d e"),
        ("a<svg/>b<math/>c", "abc"),
        ("<select><option>a<option selected>b</select>", "b"),
        ("<select><option>a</option><option data-x='selected'>b</option></select>", "a"),
        ("x <select><optgroup label=G><option>a<optgroup label=H><option selected label='B'>b</select> y", "x B y"),
        ("<select multiple><option>a<option>b</select>", "a\nb"),
        ("<select></select>x", "x"),
        ("a<xmp>  <b>&amp;</b>\n x</xmp>b", "a\n\n  <b>&amp;</b>\n x\n\nb"),
    ],
)
def test_visible_elements(page, text):
    assert html_text.Page(page).text == text
