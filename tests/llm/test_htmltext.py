import random

from tidemark.llm.htmltext import extract, visible_text

PAGE = """<!DOCTYPE html><title>no</title><h1>Head</h1>one <b>two</b>
 three<p>para<p>next &amp;<br>line<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>tail
<table><caption>Cap</caption><tr><th>Name<th>N<tr><td>long name<td>1<tr><td colspan=2>both
<tr><td rowspan=2>r<td>2<tr><td>3</table><pre>
 a
   b</pre><div style="display:none">hid</div><div style="visibility:hidden">v<span style="visibility:visible">seen</span>
</div><blockquote>q<p>r</blockquote><details><summary>s</summary>x</details><![if foo]>z<hr>end<script>x</p></script>"""

TEXT = """Head

one two three

para

next &
line

- a
- b
  3. x
  4. y
- c

tail

Cap
Name      | N
long name | 1
both
r         | 2
          | 3

 a
   b

seen

> q
>
> r

s
z

---

end"""


def test_layout():
    assert visible_text(PAGE) == TEXT


def test_odd_pages():
    assert visible_text("") == ""
    assert visible_text("<p>unclosed <b>bold") == "unclosed bold"
    assert visible_text("a</div></p>b <!-- c --> <x-y>d</x-y>") == "a\n\nb d"
    assert visible_text("<td>cell</td> outside") .split() == ["cell", "outside"]
    assert visible_text("<div>" * 50000 + "deep") == "deep"
    assert visible_text("<b><p>one</b><p>two") == "one\n\ntwo"
    assert visible_text("<p hidden>x</p><noscript>y</noscript>&nbsp;z") .strip() == "z"
    assert visible_text("<table><td colspan=1000000000>a<td rowspan=x>b</table>") == "a |  | b"
    assert visible_text("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>") == "in | ner | out"
    assert visible_text("<ol><li value=7>a<li>b</ol>") == "7. a\n8. b"


def build(rng, depth, words):
    """A random tree as HTML, and the words a reader sees."""
    tag = rng.choice("p div span b ul ol table section em h2 blockquote hidden script display".split())
    inner, seen = [], []
    for _ in range(rng.randrange(1, 4)):
        if depth and rng.random() < 0.6:
            html, more = build(rng, depth - 1, words)
        else:
            html = f"w{next(words)}"
            more = [html]
            html = rng.choice([" ", "\n"]) + html + " "
        inner.append(html)
        seen += more
    if tag in ("ul", "ol"):
        return f"<{tag}>" + "".join(f"<li>{x}" + "</li>" * rng.randrange(2) for x in inner) + f"</{tag}>", seen
    if tag == "table":
        cells = "".join("<tr>" * rng.randrange(2) + f"<td>{x}" + "</td>" * rng.randrange(2) for x in inner)
        return f"<table>{cells}</table>", seen
    body = "".join(inner)
    if tag == "hidden":
        return f"<div hidden>{body}</div>", []
    if tag == "display":
        return f"<section style='color:red; Display : none'>{body}</section>", []
    if tag == "script":
        return "<script>if (a<b) '<p>'</script>", []
    return f"<{tag}>{body}</{tag}>", seen


def single_line(text):
    return [w for w in text.replace("|", " ").replace(">", " ").split() if w.startswith("w")]


def test_no_visible_word_is_lost():
    rng = random.Random(4)
    for _ in range(300):
        html, seen = build(rng, 4, iter(range(10**6)))
        found = single_line(visible_text(html))
        assert sorted(found) == sorted(seen), html
        if "<table" not in html:
            assert found == seen, html


def test_rows(spark):
    rows = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (2, None, None, "t"), (None, "x", "", "t"), (3, "l", "<p>a " * 40000, "t")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(extract(frame).collect(), key=lambda r: (r["page_id"] or 0))
    assert [r["text"] if r["page_id"] != 3 else len(r["text"]) for r in got] == ["", TEXT, TEXT, None, 40000 + 2 * 39999]
    assert extract(frame.limit(0)).count() == 0


def test_text_that_browsers_show_is_kept():
    assert visible_text('<p style="backface-visibility: hidden; color:red">flip</p>') == "flip"
    assert visible_text('<p style="color:red; visibility : hidden">veiled</p>') == ""
    assert visible_text("<svg><title>no</title><defs><text>no</text></defs><text>chart label</text></svg>") == "chart label"
    assert visible_text("<object data=x><p>fallback</p></object>") == "fallback"
    assert visible_text("<map name=m><a href=x>area link</a><area></map>") == "area link"
    assert visible_text("<select><option>one<option selected>two<option>three</select>") == "two"
    assert visible_text("<select><optgroup label=g><option>first<option>second</optgroup></select>") == "first"
    assert visible_text("<select multiple><option>one<option>two</select>").split() == ["one", "two"]
    assert visible_text("<select></select>") == ""
