import http.server
import threading

import pytest

from quillstone.sources import fetch


@pytest.fixture
def server():
    """Answers by path: /ok, /busy (twice 503, then well), /gone, /post."""
    seen = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            seen.append(self.path)
            busy = self.path.startswith("/busy") and seen.count(self.path) < 3
            status = 503 if busy else 404 if self.path == "/gone" else 200
            self.send_response(status)
            if busy:
                self.send_header("Retry-After", "7")
            self.end_headers()
            self.wfile.write(b"<p>\xc3\xa9</p>")

        def do_POST(self):
            said = self.rfile.read(int(self.headers["Content-Length"]))
            seen.append("POST")
            self.send_response(400 if seen.count("POST") < 2 else 200)
            self.end_headers()
            self.wfile.write(said)

        def log_message(self, *args):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", seen
    s.shutdown()


def test_waits():
    assert [fetch.PAGES.wait(i) for i in (0, 1, 2, 9)] == [15, 30, 60, 300]
    assert fetch.PAGES.wait(0, "42") == 42 and fetch.PAGES.wait(0, "4200") == 300 and fetch.PAGES.wait(1, "soon") == 30
    assert fetch.PAGES.wait(5, network=True) == 480
    assert [fetch.REGISTER.wait(i, "42") for i in (0, 3, 6)] == [3, 24, 30] and fetch.REGISTER.wait(6, network=True) == 30


def test_get(server):
    url, seen = server
    waited = []
    assert fetch.get(f"{url}/ok", None, {}, fetch.PAGES, waited.append) == (200, "<p>é</p>", None) and waited == []
    assert fetch.get(f"{url}/busy", None, {}, fetch.PAGES, waited.append)[0] == 200 and waited == [7, 7]
    assert fetch.get(f"{url}/gone", None, {}, fetch.PAGES, waited.append) == (404, None, "status 404") and seen.count("/gone") == 1
    assert fetch.get(f"{url}/post", '{"a": 1}', {}, fetch.REGISTER, waited.append) == (200, '{"a": 1}', None) and waited == [7, 7, 3]
    status, body, error = fetch.get("http://127.0.0.1:1/", None, {}, fetch.PAGES, waited.append)
    assert (status, body) == (None, None) and "Error" in error and waited[3:] == [15, 30, 60]


def test_fetched_keeps_errors_with_their_rows_and_spaces_requests(spark, server, tmp_path):
    import time

    url, seen = server
    rows = spark.createDataFrame([(f"{url}/ok?{i}",) for i in range(4)] + [(f"{url}/gone",), (None,), ("nonsense",)], "url string")
    t = time.time()
    fetch.fetched(rows, fetch.Policy(delay=0.3, tries=0)).write.parquet(str(tmp_path / "landed"))
    assert time.time() - t > 4 * 0.3
    got = {r["url"]: r for r in spark.read.parquet(str(tmp_path / "landed")).collect()}
    assert got[f"{url}/ok?2"]["body"] == "<p>é</p>" and got[f"{url}/ok?2"]["error"] is None
    assert got[f"{url}/gone"]["status"] == 404 and got["nonsense"]["error"] and got[None]["error"]
    assert sorted(seen) == sorted([*(f"/ok?{i}" for i in range(4)), "/gone"])
