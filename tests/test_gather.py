"""Whole runs against a small portal and a register's service, from addresses to a committed store."""

import json
from dataclasses import replace

import pytest

from quillstone.plans import gather, mirror
from quillstone.plans.config import config_of
from quillstone.sources import corpus
from quillstone.sources.fetch import Policy, fetched

from .test_portal import LINK, Portal
from .test_register_answers import COLUMNS, WORDS, answer

NOW = "2024-02-01T00:00:00Z"
QUICK = Policy(delay=0.0, tries=0)


class Site(Portal):
    """Finals 2020_0 to 2020_24 of act 32, some archived; a page each. The register has two records, the first address of one of which fails."""

    def __init__(self):
        super().__init__()
        self.finals, self.archived, self.answers, self.down = [f"2020_{i}" for i in range(25)], [], {}, False

    def answer(self, path):
        kind, _, query = path.partition("?")
        if self.down and "search" in path:
            return ""
        if kind.endswith("count"):
            n = len(self.finals) if "start" not in query else 2
            return json.dumps([{"selector": "#view-count-final", "data": str(n)}])
        if "/publicId/" in kind:
            i = kind.rsplit("/", 1)[1]
            return f'<dl class="metadata"><dt>Question ID</dt><dd>{i}</dd><dt>Status</dt><dd>Final Q&amp;A</dd><dt>Legal act</dt><dd>Directive 2013/36/EU</dd><dt>Question</dt><dd><p>Q {i}</p></dd><dt>Answer</dt><dd><p>{self.answers.get(i, "yes")}</p></dd></dl>'
        if kind == "/esma/77":
            return "<details><p>Ask</p></details><details><p>Tell</p></details>"
        if "search" in kind or "archive" in kind:
            page = int(query.split("page=")[1].split("&")[0])
            ids = self.archived if "archive" in kind else self.finals[:2] if "start" in query else self.finals
            return "<html>" + "".join(LINK.format(i) for i in ids[page * 20 : page * 20 + 20])
        return ""


@pytest.fixture
def site():
    s = Site()
    yield s
    s.server.shutdown()


def service(base):
    asked = []

    def ask(url, body, headers):  # noqa: ARG001
        asked.append(url)
        if "modelsAndExploration" in url:
            return '{"models": [{"id": 5}]}'
        if "conceptualschema" in url:
            return json.dumps({"schemas": [{"schema": {"Entities": [{"Name": "Q", "Properties": [{"Name": c} for c in COLUMNS]}]}}]})
        return answer([{"C": ["DORA1", 1, "77", 19_000 * 86_400_000, 19_700 * 86_400_000, 0, 0, "3", "t", f"{base}/esma/77", "EC"]}, {"C": ["DORA2", 1, "78", 1, "no address"], "R": 0b00111100000 | 1 << 3, "Ø": 1 << 10}], words=WORDS | {"D2": ["DORA - Regulation (EU) 2022/2554"]})

    ask.asked = asked
    return ask


CONFIG = config_of({"joint_acts": {"DORA": {"register_act": "DORA", "act_ref": "2022/2554"}}, "eba": {"legal_act_ids": [32, 33], "default_act_ref": "2013/36", "require_status": "Final"}})


def one_run(spark, site, store, tmp_path, last="2024-01-31", config=CONFIG, ask=None, **more):
    got = gather.gather(spark, config, site.base, lambda r: fetched(r, QUICK), NOW, last, str(tmp_path / "w"), "http://service", "k", ask or service(site.base))
    before = store.version()
    r = mirror.mirror_run(got, store.read("records", version=before), store.read("state", version=before), last, config, NOW, str(tmp_path / "w"), **more)
    v = mirror.commit(store, r, before)
    return r, {x["authority"]: x.asDict() for x in r.totals.collect()}, v


def test_runs_from_addresses_to_a_store(spark, site, tmp_path):
    store = mirror.open_store(spark, f"file://{tmp_path}/store")
    r, n, v = one_run(spark, site, store, tmp_path, last="2024-01-31")
    corpus.append_run(r.run, str(tmp_path / "log"))
    line = corpus.read_runs(spark, str(tmp_path / "log")).first()
    assert line["mode"] == "incremental" and line["totals"]["eba"]["written"] == 25
    assert {k: n["eba"][k] for k in ("enumerated", "seen", "written", "errors")} == {"enumerated": 25, "seen": 25, "written": 25, "errors": 0}
    assert (n["esma"]["enumerated"], n["esma"]["written"], n["esma"]["errors"]) == (2, 1, 1) and not r.ok
    assert {x["part"]: x["rows"] for x in store.manifest("records").collect()} == {"crd": 25, "dora": 1}
    row = store.read("records", ["dora"]).first()
    assert (row["key"], row["joint_id"], row["legal_act"], row["question"], row["extra"]) == ("esma:77", "DORA1", "DORA", "Ask", {"answered_by": "EC"})
    pages = [a for a in site.asked if "publicId" in a]
    assert len(pages) == 25 and not any("archive" in a for a in site.asked)
    assert any("qa_legal_act%5B%5D=32&qa_legal_act%5B%5D=33&page=0" in a for a in site.asked) and any("publishing_date_start=18%2F01%2F2024" in a for a in site.asked)
    # the second run asks for the window and what is unverified, and writes only the family that changed
    site.asked.clear()
    site.answers["2020_1"] = "no"
    r, n, w = one_run(spark, site, store, tmp_path)
    assert {a.rsplit("/", 1)[1] for a in site.asked if "publicId" in a} == {"2020_0", "2020_1"} and n["eba"]["written"] == 1
    assert w.of("records")["crd"].version == 2 and w.of("records")["dora"] == v.of("records")["dora"]
    assert store.read("records", ["crd"]).where("key = 'eba:2020-1'").first()["answer"] == "no"
    # some vanish: now the archive is asked for
    site.asked.clear()
    site.finals, site.archived = [i for i in site.finals if i not in ("2020_7", "2020_8")], ["2020_7"]
    r, n, _ = one_run(spark, site, store, tmp_path)
    assert (n["eba"]["archived"], n["eba"]["delisted"]) == (1, 1) and any("archive" in a for a in site.asked)
    marks = {x["key"]: x["extra"] for x in store.read("records").collect() if x["extra"].keys() & {"archived", "delisted"}}
    assert marks == {"eba:2020-7": {"archived": "2024-02-01"}, "eba:2020-8": {"delisted": "2024-02-01"}}
    assert store.read("state").where("hash LIKE 'delisted:%'").count() == 2 and store.read("state").count() == 26


def test_what_cannot_be_had_is_noted(spark, site, tmp_path):
    store = mirror.open_store(spark, f"file://{tmp_path}/store")
    one_run(spark, site, store, tmp_path)
    site.down = True

    def no_service(url, body, headers):  # noqa: ARG001
        raise OSError("no service")

    r, n, _ = one_run(spark, site, store, tmp_path, ask=no_service)
    assert not r.ok and n["eba"]["delisted"] == n["esma"]["delisted"] == 0 and n["eba"]["errors"] >= 1 and n["esma"]["errors"] >= 1
    assert store.read("records").count() == 26
    site.down = False
    got = gather.gather(spark, replace(CONFIG, max_pages=1), site.base, lambda x: fetched(x, QUICK), NOW, "2024-01-31", str(tmp_path / "w"))
    assert got.announced == 25 and got.listing.count() == 0 and got.register_failed
