"""Page layout: tables as grids, lists, implied end tags, and what broken markup leaves."""

import pytest

from venuegrid.sources.markup import layout

CASES = {
    "cells in columns": ("<table><tr><td>Lundi</td><td>09:00-12:00</td></tr><tr><td>Mercredi</td><td>fermé</td></tr></table>", "Lundi     09:00-12:00\nMercredi  fermé"),
    "implied ends": ("<table><thead><tr><th>a<th>b<tbody><tr><td>cc<td>d</table>after", "a   b\ncc  d\nafter"),
    "colspan": ("<table><tr><th colspan=2>Horaires</th><th>x</th></tr><tr><td>a</td><td>b</td><td>c</td></tr></table>", "Horaires  x\na  b      c"),
    "rowspan": ("<table><tr><td rowspan=2>Lundi</td><td>a</td></tr><tr><td>b</td></tr><tr><td>Mardi</td><td>c</td></tr></table>", "Lundi  a\n       b\nMardi  c"),
    "rowspan of many lines": ("<table><tr><td rowspan=2>1<br>2<br>3</td><td>a</td></tr><tr><td>b</td></tr><tr><td>4</td><td>c</td></tr></table>", "1  a\n2  b\n3\n4  c"),
    "several lines in a cell": ("<table><tr><td>Lundi</td><td>09:00<br>12:00</td><td>x</td></tr><tr><td>Ma</td><td>-</td></tr></table>", "Lundi  09:00  x\n       12:00\nMa     -"),
    "nested table": ("<table><tr><td>a</td><td><table><tr><td>b</td><td>c</td></tr><tr><td>dd</td><td>e</td></tr></table></td></tr></table>", "a  b   c\n   dd  e"),
    "empty columns and rows": ("<table><tr><td></td><td>x</td><td> </td><td>y</td></tr><tr><td></td></tr></table>", "x  y"),
    "odd spans": ("<table><tr><td colspan=0>a</td><td rowspan='-1'>b</td><td colspan=x>c</td></tr></table>", "a  b  c"),
    "text outside cells": ("<table>one<tr>two<td>a</td></tr></table>", "onetwo\na"),
    "cells without a row": ("<table><td>a</td><td>b</td><tr><td>c</td></table>", "a  b\nc"),
    "a wide cell": (f"<table><tr><td>{'w' * 300}</td><td>z</td></tr><tr><td>a</td><td>b</td></tr></table>", f"{'w' * 300}  z\na  b"),
    "lists": ("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>x<ol><li>e<li>f</ol>", "  * a\n      + b\n      + c\n  * d\nx\n  1. e\n  2. f"),
    "list in a cell": ("<table><tr><td>k</td><td><ul><li>a</li><li>b</li></ul></td></tr></table>", "k    * a\n     * b"),
    "unclosed head": ("<head><meta charset=x><title>t</title><body><p>visible", "visible"),
    "text in a head": ("<head><title>t</title>visible", "visible"),
    "script and style": ("a<script>if (a < b) '</p>'</script><style>p{}</style>b<template>c</template>", "ab"),
    "unclosed script": ("a<script>b", "a"),
    "line ends": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "white space": (" <p> a \n\t b </p>\n<p>c <b> d</b>e</p>", "a b\n\nc de"),
    "preformatted": ("<pre>\n a\n   b  \n</pre>x", " a\n   b\nx"),
    "paragraphs by the next block": ("<p>a<p>b<div>c</div>", "a\n\nb\n\nc"),
    "after the body": ("<body>a</body></html>b", "ab"),
    "entities": ("&eacute;&amp;&#233;&nbsp;&lt;&unknown;", "é&é <&unknown;"),
    "deep": ("<div>" * 3000 + "x" + "</div>" * 3000 + "<p>y", "x\n\ny"),
    "deep tables": ("<table><tr><td>" * 400 + "x", "x"),
    "an open comment": ("a<!-- b", "a<!-- b"),
    "nothing": ("<p></p><ul><li></ul><table></table>", ""),
}


@pytest.mark.parametrize("case", CASES)
def test_layout(case):
    html, wanted = CASES[case]
    assert layout(html) == wanted


def test_entities_cut_short():
    """The old names count without their semicolon, as in browsers; this holds at a tag and at the end of a text."""
    assert layout("<h1>a &amp</h1><p>b &lt 1 &copy") == "a &\n\nb < 1 ©"


def test_long_tables_are_linear():
    rows = 20_000
    text = layout("<table>" + "<tr><td>a</td><td>b</td></tr>" * rows + "</table>")
    assert text.count("\n") == rows - 1
