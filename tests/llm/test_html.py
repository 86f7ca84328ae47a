"""Visibility, tables and hostile markup of the HTML renderer, against plain resolvers."""

import random
import time

import pytest

from tillroll.llm import html_text


@pytest.mark.parametrize("page, text", [
    ("<div style='visibility:hidden'>a<p style='visibility:visible'>b<i style='visibility:inherit'>c</i></p>d</div>e", "bc\n\ne"),
    ("<style>.h{visibility:hidden} .h .v{visibility:visible}</style><div class=h>a<b class=v>b</b><i>c</i></div>", "b"),
    ("<style>.menu a{display:none}</style><div class=menu><a>no</a><b>yes</b></div><a>yes</a>", "yes\nyes"),
    ("<style>nav > .x, [data-off]{display:none}</style><nav><i class=x>no</i><b><i class=x>yes</i></b></nav><p data-off>no", "yes"),
    ("<style>.a + .b, .a:first-child, [lang=de]{display:none}</style><p class=a>one<p class=b lang=de>two", "one\n\ntwo"),
    ("<style>.menu a{display:none} .menu a{display:inline}</style><div class=menu><a>yes</a></div>", "yes"),
    ("<style>.menu a{display:none !important} #x{display:inline}</style><div class=menu><a id=x>no</a></div>", ""),
    ("<style>div{display:flex}</style><div hidden>yes</div><p hidden>no</p>", "yes"),
    ("<ul style='visibility:hidden'><li>a<li style='visibility:visible'>b</ul>", "- b"),
    ("<ol><li>a<li value=7>b<li>c</ol>", "1. a\n7. b\n8. c"),
    ("<style>@import 'a;b'; .x{display:none}</style><p class=x>no</p>yes", "yes"),
])
def test_visibility(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize("page, text", [
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>", "A | B\n  | C"),
    ("<table><tr><td>A<td rowspan=2>B<td>C<tr><td>D<td>E</table>", "A | B | C\nD |   | E"),
    ("<table><tr><td colspan=2>A<td>B<tr><td>C<td>D<td>E</table>", "A |   | B\nC | D | E"),
    ("<table><tr><td rowspan=0>A<td>B<tr><td>C<tr><td>D<tbody><tr><td>E</table>", "A | B\n  | C\n  | D\nE"),
    ("<table><tr><td rowspan=2 colspan=2>A<td>B<tr><td>C<tr><td>D<td>E<td>F</table>", "A |   | B\n  |   | C\nD | E | F"),
    ("<table><tr><td style='visibility:hidden'>A<td>B<tr><td>C<td>D</table>", "  | B\nC | D"),
    ("<table><tr><td>A<table><tr><td>x<td>y</table><td>B</table>", "A     | B\n      |\nx | y |"),
])
def test_tables(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize("page, title", [
    ("<title>a &amp;  b</title>x", "a & b"), ("<title>a", "a"), ("<script>'<title>no</title>'</script><title>t</title>", "t"),
    ("<!-- <title>no</title> -->x", ""), ("<title>a</title><svg><title>b</title></svg>", "a"), ("", ""),
])
def test_titles(page, title):
    assert html_text.read_page(page)[0] == title


def _random_page(pick):
    """A page of nested elements whose texts are numbered, and the texts that a browser shows: display
    and visibility of every element resolved one by one from the root."""
    rules = [(f".{pick.choice('abc')} .{pick.choice('abc')}" if pick.random() < .4 else f".{pick.choice('abc')}",
              pick.choice(["display:none", "display:block", "visibility:hidden", "visibility:visible"])) for _ in range(pick.randrange(4))]
    shown, texts = [], iter(range(10 ** 6))

    def says(path, prop, inline):
        best = None
        for k, (selector, declaration) in enumerate(rules):
            name, value = declaration.split(":")
            parts = selector.split()
            if name == prop and parts[-1][1] == path[-1] and (len(parts) == 1 or parts[0][1] in path[:-1]):
                best = max(best or (0, 0, ""), (len(parts), k, value))
        return inline.get(prop, best and best[2])

    def element(path, seen, displayed):
        own, inline = pick.choice("abcd"), {}
        if pick.random() < .3:
            inline = dict([pick.choice([("display", "none"), ("display", "block"), ("visibility", "hidden"), ("visibility", "visible")])])
        path = path + [own]
        displayed = displayed and says(path, "display", inline) != "none"
        visibility = says(path, "visibility", inline)
        seen = seen if visibility is None else visibility == "visible"
        body = ""
        for _ in range(pick.randrange(1, 4)):
            if pick.random() < .5 and len(path) < 6:
                body += element(path, seen, displayed)
            else:
                n = next(texts)
                body += f" t{n} "
                if seen and displayed:
                    shown.append(f"t{n}")
        style = ";".join(f"{k}:{v}" for k, v in inline.items())
        return f"<div class={own} style='{style}'>{body}</div>"

    body = "".join(element([], True, True) for _ in range(3))
    return "<style>" + " ".join(f"{s}{{{d}}}" for s, d in rules) + "</style>" + body, shown


def test_visibility_against_plain_resolver():
    for seed in range(500):
        page, shown = _random_page(random.Random(seed))
        assert html_text.render(page).split() == shown, page


def _million(piece):
    return piece * (1_000_000 // len(piece))


@pytest.mark.parametrize("name, page", [
    ("titles", _million("<title>")), ("semicolons", "<style>" + _million(" ;")), ("bodies", "<table>" + _million("<tbody>")),
    ("wide cells", "<table><tr>" + _million("<td colspan=1000>x")),
    ("long spans", "<table><tr>" + _million("<td rowspan=65534>")[:500_000] + ">" + _million("<tr><td>x")[:500_000]),
    ("uneven spans", "<table><tr>" + "".join(f"<td rowspan={k}>x" for k in range(2, 20_000)) + _million("<tr><td>x")[:500_000]),
    ("long cell", "<table><tr><td>" + "x" * 500_000 + _million("<tr><td><td>x")[:500_000]),
    ("same rules", "<style>" + _million("b .a{display:none}.a{display:block}")[:500_000] + "</style>" + _million("<p class=a>x")[:500_000]),
    ("tags", _million("<a b='")), ("ends", _million("</p></b>")), ("deep", _million("<div>")), ("quotes", _million("<a b=\"c>")),
])
def test_hostile_pages_take_seconds(name, page):
    start = time.process_time()
    html_text.read_page(page)
    assert time.process_time() - start < 20


@pytest.mark.parametrize("before", ["", "<table>" + "<tr><td>" + "y" * 500 + "<td>z" + "<tr><td>a<td>b" * 5000 + "</table>",
                                    "<table>" + "<tr><td rowspan=0>" * 2000 + "</table>"])
def test_layout_of_a_table_does_not_depend_on_the_page(before):
    """5000 rows of 500 blanks, or two million spanned columns, come before or not."""
    table = "<table><tr><td rowspan=2>long name<td>B<tr><td>C<tr><td>D<td>E</table>"
    assert html_text.render(before + table).endswith("long name | B\n          | C\nD         | E")


@pytest.mark.parametrize("n", [10, 20_000])
def test_every_row_of_a_table_is_aligned(n):
    page = "<table><tr><td>" + "x" * 300 + "<td>y" + "<tr><td>a<td>b" * n + "</table>"
    assert html_text.render(page).split("\n") == ["x" * 300 + " | y"] + ["a" + " " * 299 + " | b"] * n


def test_a_column_is_padded_up_to_a_fixed_width():
    page = "<table><tr><td>" + "x" * 600 + "<td>y<tr><td>a<td>b<tr><td><td>c</table>"
    assert html_text.render(page).split("\n") == ["x" * 600 + " | y", "a" + " " * 511 + " | b", " " * 510 + "| c"]


def _slow_columns(rows):
    """Columns of each row's cells (colspan, rowspan) by a table of taken cells."""
    taken, out = set(), []
    for at, row in enumerate(rows):
        column, columns = 0, []
        for wide, high in row:
            while (at, column) in taken:
                column += 1
            columns.append(column)
            taken |= {(at + r, column + c) for r in range(1, high or len(rows)) for c in range(wide)}
            column += wide
        out.append(columns)
    return out


def test_row_spans_against_a_table_of_taken_cells():
    for seed in range(200):
        draw = random.Random(seed)
        rows = [[(draw.choice([1, 1, 2, 5]), draw.choice([1, 1, 0, 2, 3, 7])) for _ in range(draw.randint(0, 6))] for _ in range(12)]
        spans, found = html_text._Spans(), []
        for at, row in enumerate(rows):
            cells = "".join(f"<td colspan={wide} rowspan={high}>x" for wide, high in row)
            tree, styles = html_text.build_tree(f"<table><tr>{cells}</table>")
            node = next(iter(tree.children[0].children))
            found.append([c for c, _ in html_text._row(node, spans, at, html_text.Node("div"), styles)])
        assert found == _slow_columns(rows)


@pytest.mark.parametrize("name, page", [
    ("many lines beside many cells", "<table><tr>" + _million("<td>x")[:500_000] + "<td>" + _million("x<br>")[:500_000]),
    ("spans of many heights", "<table><tr>" + "".join(f"<td colspan=1000 rowspan={k}>x" for k in range(2, 15_000)) + _million("<tr><td>x")[:500_000]),
    ("tables in cells", "<table><tr><td>" + "y" * 600 + "<td>z<tr><td><td>" * 1 + "<table><tr><td>yyyyyyyyyyyy<td>z<tr><td><td>" * 45 + _million("x<br>")[:200_000]),
])
def test_layout_of_hostile_pages_is_bounded(name, page):
    start = time.process_time()
    _, text = html_text.read_page(page)
    assert time.process_time() - start < 30 and len(text) < 1_500 * len(page)
