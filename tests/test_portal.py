import re
import threading
from datetime import date
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from quillstone.scratch import Scratch
from quillstone.sources import portal
from quillstone.sources.register import ListingTruncated

LINK = '<a href="/single-rule-book-qa/qna/view/publicId/{}">x</a>'


class Portal:
    """A small portal: 45 final entries of act 32 and 20 of act 33, published from 2024-01-01 on, one a day, and 5 archived ones. Page 1 of act 32 is a shell unless caches are passed."""

    def __init__(self):
        self.asked = []
        outer = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):  # noqa: N802
                outer.asked.append(self.path)
                body = outer.answer(self.path).encode()
                self.send_response(200 if body else 404)
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *a):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.base = f"http://127.0.0.1:{self.server.server_port}"

    def answer(self, path):
        u = urlsplit(path)
        q = parse_qs(u.query)
        acts = q.get("qa_legal_act[]", ["32", "33"])
        d, m, y = map(int, q.get("qa_final_publishing_date_start", ["01/01/2024"])[0].split("/"))
        skip = (date(y, m, d) - date(2024, 1, 1)).days
        n = {"32": 45, "33": 20} if "search" in u.path else {"32": 5, "33": 0}
        if u.path.endswith("qa-search-count"):
            return '[{"command":"insert","selector":"#view-count-final","data":"<b>%d</b>"},{"selector":"#other","data":"7"},{"selector":"#view-count-archive","data":"5"}]' % sum(max(0, n[a] + 0 - skip) for a in acts)
        page = int(q["page"][0])
        links = [f"{a}_{i}" for a in acts for i in range(skip, n[a])][page * 20 : page * 20 + 20]
        if page == 1 and acts == ["32"] and "cachebust" not in q:
            links = []
        return "<html>" + "".join(LINK.format(x) for x in links)


@pytest.fixture
def site():
    p = Portal()
    yield p
    p.server.shutdown()


@pytest.fixture
def listing(spark, site):
    portal.register_sources(spark)
    return spark.read.format("qa_listing").options(base=site.base, delay="0", tries="0")


def plain(asked):
    return sorted(re.sub(r"cachebust=\d+", "cachebust", a) for a in asked)


def test_filters_become_facets_of_the_address(listing, site):
    rows = listing.load().where("status = 'final' AND act = 32 AND published >= '2024-01-31'").collect()
    assert sorted(r["link"].rsplit("/", 1)[1] for r in rows) == sorted(f"32_{i}" for i in range(30, 45))
    assert {(r["status"], r["act"], r["published"], r["page_no"]) for r in rows} == {("final", 32, date(2024, 1, 31), 0)}
    # one page with links, two without, and a second try for each of these
    head = "/single-rule-book-qa/search?qa_legal_act%5B%5D=32&qa_final_publishing_date_start=31%2F01%2F2024&page="
    assert plain(site.asked) == sorted([f"{head}0", f"{head}1", f"{head}1&cachebust", f"{head}2", f"{head}2&cachebust"])


def test_a_shell_is_asked_for_past_caches(listing, site):
    rows = listing.load().where("status = 'final' AND act IN (32)").collect()
    assert len(rows) == 45 and {r["page_no"] for r in rows} == {0, 1, 2}
    assert sum("cachebust" in a for a in site.asked) == 3 and len(site.asked) == 5 + 3


def test_several_acts_and_tabs_are_walks_of_their_own(listing, site):
    rows = listing.option("acts", "32,33,34").load().where("act IN (32, 33)").groupBy("status", "act").count().collect()
    assert {tuple(r) for r in rows} == {("final", 32, 45), ("final", 33, 20), ("archive", 32, 5)}
    assert not any("34" in re.findall(r"%5D=(\d+)", a) for a in site.asked)


def test_filters_that_leave_nothing_ask_for_nothing(listing, site):
    assert listing.load().where("status = 'review'").count() == 0
    assert listing.option("acts", "32").load().where("act = 33").count() == 0
    assert site.asked == []


def test_counts_of_tabs(listing, site):
    rows = listing.option("table", "counts").load().where("act = 32 AND published >= '2024-01-11'").collect()
    assert sorted((r["status"], r["n"]) for r in rows) == [("archive", 5), ("final", 35)]
    assert len(site.asked) == 1


def test_counts_fail_open_and_listings_closed(spark, listing):
    gone = listing.option("base", "http://127.0.0.1:9").option("table", "counts")
    assert gone.load().where("act = 32").count() == 0
    with pytest.raises(Exception, match="127.0.0.1:9"):
        spark.read.format("qa_listing").options(base="http://127.0.0.1:9", delay="0", tries="0").load().count()


def test_a_listing_beyond_its_budget_is_an_error(listing):
    with pytest.raises(Exception, match="goes on after 2 pages"):
        listing.option("max_pages", "2").load().where("status = 'final' AND act = 32").count()


def test_addresses():
    f = portal.Facets("archive", (32, 33), date(2024, 2, 3))
    assert f.listing("http://x") == "http://x/single-rule-book-qa/archive?qa_legal_act%5B%5D=32&qa_legal_act%5B%5D=33&qa_final_publishing_date_start=03%2F02%2F2024&page="
    assert portal.Facets().counts("http://x") == "http://x/qa-search-count?"
    assert portal.tab_numbers("no json") == portal.tab_numbers('{"a": 1}') == portal.tab_numbers("[1]") == {}


# --- waves ------------------------------------------------------------------------------------------------------------------------------


def plain_walk(pages, retries, max_pages):
    """pages, retries: page -> links."""
    seen, stale, asked, got = set(), 0, [], []
    for page in range(max_pages):
        new = set(pages.get(page, ())) - seen
        asked.append((page, False, len(new)))
        if not new:
            new = set(retries.get(page, ())) - seen
            asked.append((page, True, len(new)))
        if not new:
            stale += 1
            if stale == 2:
                return asked, sorted(got)
            continue
        stale = 0
        seen |= new
        got += [(page, x) for x in new]
    return None


LISTINGS = {
    "empty": ({}, {}),
    "short": ({0: "ab", 1: "bc", 2: "ab", 3: "a"}, {}),
    "one barren page": ({0: "ab", 1: "", 2: "cd", 3: "d", 4: "e", 5: "", 6: ""}, {}),
    "shells": ({0: "", 1: "ab", 2: "", 3: "c"}, {0: "xy", 2: "zz", 4: "q"}),
    "pinned": ({i: "ab" + "cdefg"[i] for i in range(5)}, {}),
}


def test_waves_ask_for_what_a_walk_asks_for(spark):
    responses = [(f"http://p/{s}?page={p}", "".join(LINK.format(x) for x in links)) for s, (pages, _) in LISTINGS.items() for p, links in pages.items()]
    responses += [(f"http://p/{s}?page={p}&again", "".join(LINK.format(x) for x in links)) for s, (_, again) in LISTINGS.items() for p, links in again.items()]
    table = spark.createDataFrame(responses, "url string, body string")
    listings = spark.createDataFrame([(s, f"http://p/{s}?page=") for s in LISTINGS], "source string, address string")
    retry = lambda u: F.concat(u, F.lit("&again"))
    links, asked = portal.walk_by_waves(listings, portal.recorded(table), Scratch(spark, "t"), max_pages=9, retry=retry)
    for s, (pages, again) in LISTINGS.items():
        want = plain_walk({k: set(v) for k, v in pages.items()}, {k: set(v) for k, v in again.items()}, 9)
        assert sorted((r["page_no"], r["again"], r["n_new"]) for r in asked.where(F.col("source") == s).collect()) == sorted(want[0]), s
        assert sorted((r["page_no"], r["link"].rsplit("/", 1)[1]) for r in links.where(F.col("source") == s).collect()) == want[1], s
    with pytest.raises(ListingTruncated):
        portal.walk_by_waves(listings, portal.recorded(table), Scratch(spark, "t"), max_pages=4, retry=retry)


def test_waves_over_http(spark, site):
    from quillstone.sources.fetch import Policy, fetched

    address = portal.Facets(acts=(33,)).listing(site.base)
    listings = spark.createDataFrame([("a", address)], "source string, address string")
    links, asked = portal.walk_by_waves(listings, lambda r: fetched(r, Policy(delay=0.0, tries=0)), Scratch(spark, "t"))
    assert links.count() == 20 and asked.count() == len(site.asked) == 5


def test_a_second_address_is_asked_for_only_where_the_first_failed(spark):
    bodies = {"a1": "bad", "a2": "good", "b1": "good", "d2": "good", "e1": "bad"}
    asked_of = []

    def fetch(requests):
        asked_of.append(sorted(r["url"] for r in requests.collect()))
        return portal.recorded(spark.createDataFrame(list(bodies.items()), "url string, body string"))(requests)

    def parse(rows):
        return rows.select("url", F.upper("body").alias("text"), F.when(F.col("body") == "bad", "can't be read").otherwise("").alias("error"))

    keys = [("A", ["a1", "a2", "a3"]), ("B", ["b1", "b2"]), ("C", ["c1"]), ("D", ["a1", "d2"]), ("E", ["e1", "c1"]), ("F", []), ("G", ["x1", "b1"])]
    candidates = spark.createDataFrame(keys, "key string, urls array<string>")
    answers, asked = portal.first_answers(candidates, fetch, parse, Scratch(spark, "t"))
    assert sorted((r["key"], r["url"], r["ord"], r["text"]) for r in answers.collect()) == [("A", "a2", 1, "GOOD"), ("B", "b1", 0, "GOOD"), ("D", "d2", 1, "GOOD"), ("G", "b1", 1, "GOOD")]
    assert asked_of == [["a1", "b1", "c1", "e1", "x1"], ["a2", "d2"]]
    assert {(r["wave"], r["url"]): r["error"] for r in asked.collect()} == {(0, "a1"): "can't be read", (0, "b1"): "", (0, "c1"): "not recorded", (0, "e1"): "can't be read", (0, "x1"): "not recorded", (1, "a2"): "", (1, "d2"): ""}
    assert portal.first_answers(candidates.where("false"), fetch, parse, Scratch(spark, "t"))[0].count() == 0
