"""Operator 10 on pages whose text is known by construction, and on hostile ones."""

import random
import time

import pytest

from accordion.llm import html_text


def text_of(page):
    return html_text.Page(page).text


class Maker:
    """Makes a page and, beside it, the text it shows: a small renderer of its own that
    never sees the HTML."""

    def __init__(self, seed):
        self.rng = random.Random(seed)

    def words(self):
        return " ".join("".join(self.rng.choice("abcdefg") for _ in range(self.rng.randrange(1, 8))) for _ in range(self.rng.randrange(1, 6)))

    def phrase(self):
        """Inline HTML and its text."""
        made = self.words()
        kind = self.rng.randrange(7)
        if kind == 0:
            more = self.words()
            return f"{made} <b>{more}</b>", f"{made} {more}"
        if kind == 1:
            return f"{made} &amp; <!-- {self.words()} --><i>x</i>", f"{made} & x"
        if kind == 2:
            return f"{made}<script>if (a<b) '{self.words()}'</script>", made
        if kind == 3:
            return f"{made}<span hidden>{self.words()}<b>y</b></span>", made
        if kind == 4:
            return f'<a href="a>b" title=\'<p>\'>{made}</a>', made
        if kind == 5:
            return f"<span style='visibility: hidden'>{self.words()}<em style='visibility:visible'>{made}</em>gone</span>", made
        return made.replace(" ", "\n \t"), made

    def block(self, depth):
        """HTML, lines, and whether a blank line stands around it."""
        kind = self.rng.randrange(6 if depth else 3)
        page, text = self.phrase()
        if kind == 0:
            return f"<p>{page}" + self.rng.choice(["", "</p>"]), [text], True
        if kind == 1:
            return f"<div>{page}</div>", [text], False
        if kind == 2:
            return f"<h2>{page}</h2>", [text], True
        if kind == 3:
            cells = [[self.words() for _ in range(3)] for _ in range(self.rng.randrange(1, 4))]
            width = [max(len(r[i]) for r in cells) for i in range(3)]
            end = self.rng.choice(["", "</td>"])
            return "<table>" + "".join("<tr>" + "".join(f"<td>{c}{end}" for c in r) for r in cells) + "</table>", ["  ".join(c.ljust(w) for c, w in zip(r, width, strict=True)).rstrip() for r in cells], True
        if kind == 4:
            ordered, pages, lines = self.rng.random() < 0.5, [], []
            for i in range(self.rng.randrange(1, 4)):
                inner, shown = self.phrase()
                mark = f"{i + 1}. " if ordered else "- "
                lines.append(mark + shown)
                if self.rng.random() < 0.4:
                    deep, more = self.phrase()
                    inner += f"<ul><li>{deep}</ul>"
                    lines.append(" " * len(mark) + "- " + more)
                pages.append(f"<li>{inner}" + self.rng.choice(["", "</li>"]))
            tag = "ol" if ordered else "ul"
            return f"<{tag}>{''.join(pages)}</{tag}>", lines, True
        raw = [" " * self.rng.randrange(4) + self.words() for _ in range(2)]
        return "<pre>" + "\n".join(raw) + "</pre>", raw, True

    def page(self):
        pages, out, blank = [], [], False
        for _ in range(self.rng.randrange(1, 9)):
            page, lines, spaced = self.block(1)
            if page.startswith("<p>") and not page.endswith("</p>"):
                page += "</p>" if self.rng.random() < 0.5 else ""
            pages.append(page)
            out += ([""] if out and (blank or spaced) else []) + lines
            blank = spaced
        head = self.rng.choice(["", "<head><title>t</title>", "<!DOCTYPE html><html><head><meta charset=x><style>p{}</style></head><body>"])
        return head + "".join(pages), "\n".join(out).strip("\n")


@pytest.mark.parametrize("seed", range(150))
def test_made_pages(seed):
    page, text = Maker(seed).page()
    assert text_of(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<head><title>t</title><p>hello", "hello"),
        ("<head><title>t</title>hello", "hello"),
        ("<head><noscript><p>a</noscript><div>b", "a\n\nb"),
        ("<p style='visibility:hidden'>a<b style='visibility:visible'>b</b>c", "b"),
        ("x<object data=a><p>instead</p></object>", "x\n\ninstead"),
        ("<table><tr><td colspan=2>wide one<td>z<tr><td>a<td>b<td>c</table>", "wide one  z\na  b      c"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
        ("<table><tr><td>a<td rowspan=3>b<td>c<tr><td>dd<td>e<tr><td>f</table>", "a   b  c\ndd     e\nf"),
        ("<table><tr><td colspan=1000>a<td>b<tr><td>c<td>d</table>", "a     b\nc  d"),
        ("<table><tr><td><table><tr><td>1<td>2</table><td>side</table>", "1  2\n\nside"),
        ("<a \"b>c</a>", "c"),
        ("<a b=\"c>d", "d"),
        ("a < b <3 <", "a < b <3 <"),
        ("<ul><li><li>b</ul>", "-\n- b"),
        ("<ul><li><p>a<p>b<li>c</ul>", "- a\n\n  b\n- c"),
        ("<p>x<ul><li>a</ul>y", "x\n\n- a\n\ny"),
    ],
)
def test_cases(page, text):
    assert text_of(page) == text


HOSTILE = {
    "div": "<div>a",
    "p in button": "<button><p><span><div>",
    "quote": '<a "',
    "open quote": '<a b="',
    "both quotes": "<a b='\"",
    "cdata": "<![CDATA[",
    "comment": "<!-",
    "bang": "<!",
    "end tags": "</b></i>",
    "list": "<ul><li>a",
    "dl": "<dl><dd>a",
    "table": "<table><tr><td>a",
    "cells": "<td>a",
    "rows": "<tr><td colspan=9>a",
    "b": "<b>",
    "select": "<select><option>a",
    "slash": "<a /",
    "equals": "<a =",
    "space": "<a     ",
    "amp": "&am",
    "svg": "<svg><text>a",
    "title": "<title>",
    "bare": "<",
}


@pytest.mark.parametrize("name", sorted(HOSTILE))
def test_hostile_pages_take_time_in_proportion(name):
    """Half a megabyte, then a whole one: the work may not grow with the square."""
    took = []
    for size in (1 << 19, 1 << 20):
        page = (HOSTILE[name] * (size // len(HOSTILE[name]) + 1))[:size]
        began = time.process_time()
        text_of(page)
        took.append(time.process_time() - began)
    assert took[1] < 8 and (took[1] < 1 or took[1] < 3.2 * took[0])


@pytest.mark.parametrize("depth", [10, 5000])
def test_a_list_inside_and_a_block_after(depth):
    inner = "<ul><li>a</li><li>b</li></ul><div>one</div><p>two</p>"
    assert text_of("<div>" * depth + inner) == "- a\n- b\n\none\n\ntwo"
