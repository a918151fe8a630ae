"""Range join, components and co-occurrence over whole tables, against brute force."""

from collections import Counter, defaultdict

from loamstone.plans import archive, catalogue
from loamstone.sources.tables import table


def test_all_band_links(spark, data):
    shipped = Counter()
    for r in table(spark, data, "lineitem").select("l_shipdate", "l_quantity").collect():
        shipped[r.l_shipdate.date()] += r.l_quantity
    want = set()
    for r in table(spark, data, "orders").select("o_orderkey", "o_orderdate").collect():
        near = sorted((abs((d - r.o_orderdate.date()).days), -q, d) for d, q in shipped.items() if abs((d - r.o_orderdate.date()).days) <= 7)
        want |= {(r.o_orderkey, d, place) for place, (_, _, d) in enumerate(near[:3], 1)}
    got = [(r.o_orderkey, r.ship_day, r.place) for r in catalogue.QUERIES["band_links_top3"](spark, data).collect()]
    assert len(got) == len(want) and set(got) == want


def test_all_part_components(spark, data):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    suppliers = defaultdict(set)
    for r in table(spark, data, "lineitem").select("l_partkey", "l_suppkey").collect():
        suppliers[r.l_partkey].add(r.l_suppkey)
    for own in suppliers.values():
        for s in own:
            a, b = sorted((find(s), find(min(own))))
            parent[b] = a
    sizes = Counter(find(s) for s in list(parent))
    got = {r.root: r.members for r in catalogue.QUERIES["part_components"](spark, data).collect()}
    assert got == {root: n for root, n in sizes.items() if n > 1}


def test_all_tag_cooccurrence(spark, data):
    tags = {r.id: set(r.tags or ()) for r in table(spark, data, "research_record").select("id", "tags").collect()}
    want = Counter((a, b) for own in tags.values() for a in own for b in own)
    got = {(r.term_a, r.term_b): r.documents for r in archive.tag_cooccurrence(spark, data).collect()}
    assert got == want and len({a for a, _ in got}) > 10
