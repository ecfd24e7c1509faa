import http.server
import os
import threading
import urllib.error
import urllib.parse

import pytest

from marginalia.sources import readers, transport


@pytest.fixture
def pages(spark, monkeypatch):
    """Reads pages of the made-up server, whose module lies beside this file."""
    monkeypatch.syspath_prepend(os.path.dirname(__file__))
    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(__file__), "fake_client.py"))
    spark.dataSource.register(transport.PageSource)
    return lambda kind, ids: spark.read.format("pages").options(kind=kind, ids=ids, fetch="fake_client:fetch").load()


def test_category(pages):
    found = transport.as_category_pages(pages("category", "1,2"))
    items = readers.raw_items(found).orderBy("category_id", "pos").collect()
    assert [(r.category_id, r.pos, r.item_id) for r in items] == [(c, p, 10 * c + p) for c in (1, 2) for p in range(4)]
    assert {r.category_name for r in readers.raw_categories(found).collect()} == {"C1", "C2"}


def test_forum_and_topic(pages):
    topics = readers.topics(transport.as_forum_pages(pages("forum", "1,2"))).orderBy("category_id", "page_no").collect()
    assert [(r.category_id, r.topic_id) for r in topics] == [(c, t) for c in (1, 2) for t in range(9, 0, -1)]
    rows = {r.topic_id: r.error_code for r in transport.as_topic_pages(pages("topic", "5,6")).collect()}
    assert rows == {5: None, 6: "E_NO_PERMISSION"}


def test_post_client():
    """Forms, headers, another try after a server's error, and no other after a client's."""
    seen = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            form = urllib.parse.parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode())
            seen.append((form, self.headers.get("X-Key")))
            self.send_response(503 if len(seen) == 1 else 404 if form.get("topic_id") == ["404"] else 200)
            self.end_headers()
            self.wfile.write(b'{"response": {}}')

        def log_message(self, *args):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    fetch = transport.post_client(f"http://127.0.0.1:{server.server_port}/", {"session": "s 1"}, {"X-Key": "k"}, timeout=5, wait=0.01)
    assert fetch("category", 5, None) == '{"response": {}}' and len(seen) == 2
    assert seen[1] == ({"session": ["s 1"], "a": ["fetch_category_data"], "category_id": ["5"]}, "k")
    fetch("category", 5, 40)
    fetch("forum", 6, 99)
    assert seen[2][0]["start_num"] == ["40"] and seen[2][0]["parent_category_id"] == ["5"] and seen[3][0]["fetch_before"] == ["99"]
    with pytest.raises(urllib.error.HTTPError):
        fetch("topic", 404, None)
    assert len(seen) == 5
    server.shutdown()
