"""Invariants of the node arrays."""

from html.parser import HTMLParser

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.sources.shred import Needs, _Nodes

TAGS = ["p", "b", "div", "li", "ul", "table", "tr", "td", "h1", "a", "br", "script", "title", "main", "body", "html", "head", "x-y"]
PIECES = st.one_of(
    st.sampled_from([f"<{t}>" for t in TAGS] + [f"</{t}>" for t in TAGS] + [
        "<a href='x y' class=\"b c\">", "<br/>", "<!-- c -->", "<!doctype html>", "&amp;", "&nbsp;", "<", ">", "</", "<a b=", '"', " ", "\n"]),
    st.text(max_size=6))


def dom_of(html, needs=None):
    nodes = _Nodes(needs)
    nodes.page(html)
    dom, errors = nodes.columns()
    assert errors.to_pylist() == [None]
    return dom.to_pylist()[0]


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=40).map("".join))
def test_intervals_nest(html):
    dom = dom_of(html)
    if not html:
        return
    assert [n["pre"] for n in dom] == list(range(len(dom)))
    assert dom[0]["tag"] == "#document" and dom[0]["last"] == len(dom) - 1
    for n in dom[1:]:
        up = dom[n["parent"]]
        assert up["pre"] < n["pre"] <= n["last"] <= up["last"]
        assert n["level"] == up["level"] + 1 and not up["tag"].startswith("#") or up["pre"] == 0
        if n["tag"].startswith("#"):
            assert n["last"] == n["pre"]


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts = []

    def handle_data(self, data):
        self.parts.append(data)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(["<p>", "</p>", "<b>", "</b>", "<div class=x>", "</div>", "<br>", "&lt;", "&copy;"]),
                          st.text(alphabet="ab \n", max_size=8)), max_size=30).map("".join))
def test_text_is_kept(body):
    html = f"<body>{body}</body>"
    parser = _Text()
    parser.feed(html)
    parser.close()
    got = "".join(n["text"] or "" for n in dom_of(html))
    assert got.split() == "".join(parser.parts).split()


def test_first_attribute_counts_and_names_are_lower():
    a = [n for n in dom_of('<A HREF="1" href=2 Title>x')if n["tag"] == "a"][0]
    assert dict(a["attrs"]) == {"href": "1", "title": ""}


def test_implied_ends():
    def shape(html):
        return [(n["tag"], dom[n["parent"]]["tag"]) for dom in [dom_of(html)] for n in dom if not n["tag"].startswith("#")]

    assert shape("<ul><li>a<li>b</ul>")[2:] == [("ul", "body"), ("li", "ul"), ("li", "ul")]
    assert shape("<table><tr><td>1<td>2<tr><th>3</table><p>")[2:] == [
        ("table", "body"), ("tr", "table"), ("td", "tr"), ("td", "tr"), ("tr", "table"), ("th", "tr"), ("p", "body")]
    assert shape("<p>a<div>b</p></div>")[2:] == [("p", "body"), ("div", "body")]
    assert shape("<td><p>x</div></td>") [2:] == [("td", "body"), ("p", "td")]


def test_hostile_input_is_linear():
    import time

    start = time.perf_counter()
    for html in ("</a" * 200_000, "<div>" * 50_000, "<p><b>" * 50_000, "<a b='" * 50_000, "<li>" * 100_000, "<!--" * 100_000):
        dom_of(html)
    assert time.perf_counter() - start < 30


def test_time_grows_with_the_page_not_with_its_square():
    import time

    from corpusloom.sources.shred import Needs, _Nodes

    def seconds(html):
        start = time.process_time()
        _Nodes().page(html)
        return time.process_time() - start

    for part in ("<div><p>", "<li><span>", "<td><i>x", "<p><b>x</p>"):
        seconds(part * 500)
        assert seconds(part * 16_000) < 10 * max(0.02, seconds(part * 4_000)), part


NAMES = st.frozensets(st.sampled_from(["p", "b", "div", "li", "td", "h1", "a", "title", "main", "body", "template"]), max_size=4)
NEEDS = st.builds(Needs, tags=NAMES, text_in=NAMES, classes=st.sampled_from([frozenset(), frozenset("b")]), ids=st.sampled_from([frozenset(), frozenset("i")]),
                  attrs=st.sampled_from([frozenset(), frozenset(["href", "class"])]), scripts=st.sampled_from([frozenset(), frozenset(["JSON"])]))
MORE = st.one_of(PIECES, st.sampled_from(['<div class="a b">', "<p id=i>", "<a href='x>y'>", "<a b=c/>", "<p a='>", "<br class=b>", "<template><p>x</p></template>",
                                          "<script type=text/json>{1}</script>", "<script type='x'>no</script>", "<title>t &amp; u</title>"]))


@settings(max_examples=500, deadline=None)
@given(st.lists(MORE, max_size=40).map("".join), NEEDS)
def test_pruned_nodes_are_the_wanted_ones_of_the_whole(html, needs):
    """The parser told what is needed keeps exactly those nodes, numbered anew."""
    whole = dom_of(html)

    def ancestors(n):
        while n["parent"] is not None:
            n = whole[n["parent"]]
            yield n

    def kept(n):
        attrs, tag = dict(n["attrs"] or []), n["tag"]
        if tag == "#document":
            return True
        if tag == "#raw" and whole[n["parent"]]["tag"] in ("script", "style", "template", "rt", "rp"):
            return kept(whole[n["parent"]])
        if tag.startswith("#"):
            return any(a["tag"] in needs.text_in for a in ancestors(n))
        return (tag in needs.tags or (tag == "script" and bool(needs.scripts) and "json" in attrs.get("type", "").lower())
                or bool(needs.classes & set(n["classes"] or [])) or attrs.get("id") in needs.ids)

    left = [n for n in whole if kept(n)]
    number = {n["pre"]: i for i, n in enumerate(left)}
    want = []
    for i, n in enumerate(left):
        attrs = [(k, v) for k, v in n["attrs"] or [] if k in needs.attrs]
        up = next((number[a["pre"]] for a in ancestors(n) if a["pre"] in number), None)
        inside = [number[m["pre"]] for m in left if n["pre"] <= m["pre"] <= n["last"]]
        want.append({**n, "pre": i, "last": max(inside), "parent": up, "attrs": attrs or [], "classes": (n["classes"] or []) if "class" in needs.attrs else []})
    got = [{**n, "attrs": n["attrs"] or [], "classes": n["classes"] or []} for n in dom_of(html, needs)]
    assert got == want
