import http.server
import json
import struct
import threading
import zlib

import pytest

from almazara.sources import osm, web


class Handler(http.server.BaseHTTPRequestHandler):
    body = bytes(range(256)) * 40
    failures = {"n": 0}

    def log_message(self, *a):
        pass

    def do_GET(self):
        path, _, query = self.path.partition("?")
        if path == "/flaky" and self.failures["n"] < 2:
            self.failures["n"] += 1
            self.send_response(503)
            self.end_headers()
            return
        if path == "/missing":
            self.send_response(404)
            self.end_headers()
            return
        out, status = self.body, 200
        if path == "/pages":
            page = int(query.split("=")[1])
            out = json.dumps({"totalFilas": 5, "tamanioPagina": 2, "resultados": [{"i": i} for i in range(2 * page - 2, min(5, 2 * page))]}).encode()
        elif self.headers.get("Range"):
            out, status = self.body[int(self.headers["Range"][6:-1]) :], 206
        self.send_response(status)
        self.send_header("Content-Length", str(len(out)))
        self.end_headers()
        self.wfile.write(out)


@pytest.fixture(scope="module")
def site():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_fetch_and_resume(site, tmp_path):
    import hashlib

    assert web.fetch(site + "/flaky", wait=0.01) == Handler.body and web.fetch(site + "/missing", missing_ok=True) is None
    with pytest.raises(OSError, match="token=\\*\\*\\*"):
        web.fetch(site + "/missing", params={"token": "secret"}, wait=0.01)
    target, md5 = tmp_path / "f.bin", hashlib.md5(Handler.body).hexdigest()
    (tmp_path / "f.bin.part").write_bytes(Handler.body[:100])
    assert web.download(site + "/f", str(target), size=len(Handler.body), md5=md5) == "downloaded" and target.read_bytes() == Handler.body
    assert web.download(site + "/f", str(target), md5=md5) == "complete"
    with pytest.raises(OSError):
        web.download(site + "/f", str(tmp_path / "g.bin"), size=1, attempts=2, wait=0.01)


def test_pages_and_tasks(spark, site, tmp_path, rows):
    assert rows(web.read_pages(spark, site + "/pages"), "page", "value") == [(1, '{"i":0}'), (1, '{"i":1}'), (2, '{"i":2}'), (2, '{"i":3}'), (3, '{"i":4}')]
    tasks = spark.createDataFrame([("a.bin", site + "/a", len(Handler.body), None), ("b.bin", site + "/missing", None, None)], "name string, url string, bytes long, md5 string")
    web_wait = {r.name: r.status for r in web.download_all(tasks.where("name = 'a.bin'"), str(tmp_path)).collect()}
    assert web_wait == {"a.bin": "downloaded"} and (tmp_path / "a.bin").exists()


def test_forms_links_catalogues_answers(spark):
    body, kind = web.multipart({"a": "1"})
    assert b'name="a"\r\n\r\n1\r\n' in body and kind.split("=")[1].encode() in body
    page = """<a href="/x/v1.json">1</a><a href='http://y/v2.json'>2</a><a href="/x/v1.json">1</a><a href="z.pdf">3</a>"""
    from pyspark.sql import functions as F

    (r,) = spark.createDataFrame([(page,)], "h string").select(web.page_links(F.col("h"), r"\.json$", "http://s").alias("l")).collect()
    assert r.l == ["http://s/x/v1.json", "http://y/v2.json"]
    feed = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title> 02001-ABENGIBRE buildings</title><link href="http://c/02001.zip" rel="enclosure"/></entry></feed>"""
    (e,) = web.catalogue_entries(spark.createDataFrame([(feed,)], "text string")).collect()
    assert (e.href, e.code, e.name) == ("http://c/02001.zip", "02001", "ABENGIBRE")
    assert web.market_answer("<Publication_MarketDocument/>") == ("ok", None)
    assert web.market_answer("<Acknowledgement_MarketDocument><Reason><text>No matching data found</text></Reason></Acknowledgement_MarketDocument>")[0] == "no_data"


def varint(n):
    n &= (1 << 64) - 1
    out = b""
    while True:
        out += bytes([n & 0x7F | (0x80 if n > 0x7F else 0)])
        n >>= 7
        if not n:
            return out


def zig(n):
    return varint((n << 1) ^ (n >> 63))


def field(number, value):
    return varint(number << 3) + varint(value) if isinstance(value, int) else varint(number << 3 | 2) + varint(len(value)) + value


def packed(values, signed=False):
    return b"".join((zig if signed else varint)(v) for v in values)


def write_map(path, blocks):
    with open(path, "wb") as f:
        for kind, raw in [("OSMHeader", b"")] + [("OSMData", b) for b in blocks]:
            blob = field(2, len(raw)) + field(3, zlib.compress(raw))
            head = field(1, kind.encode()) + field(3, len(blob))
            f.write(struct.pack(">I", len(head)) + head + blob)


def test_map_files(spark, tmp_path, rows, monkeypatch):
    texts = [b"", b"ana", b"name", b"Casa", b"outer"]
    table = field(1, b"".join(field(1, t) for t in texts))
    dense = field(1, packed([10, 5], True)) + field(5, field(1, packed([1, 2])) + field(2, packed([1000, 60], True)) + field(3, packed([7, 1], True)) + field(4, packed([3, 0], True)) + field(5, packed([1, 0], True)) + field(6, packed([1, 0]))) + field(8, packed([400000000, 10], True)) + field(9, packed([-37000000, 0], True)) + field(10, packed([2, 3, 0, 0]))
    info = field(1, 4) + field(2, 1000) + field(3, 9) + field(4, 3) + field(5, 1)
    way = field(1, 77) + field(2, packed([2])) + field(3, packed([3])) + field(4, info) + field(8, packed([10, 5, -5], True))
    relation = field(1, 88) + field(4, info) + field(8, packed([4, 0])) + field(9, packed([77, -67], True)) + field(10, packed([1, 0]))
    path = str(tmp_path / "m.osm.pbf")
    write_map(path, [table + field(2, field(2, dense)), table + field(2, field(3, way)) + field(2, field(4, relation))])
    monkeypatch.setattr(osm, "PARTITION_BYTES", 1)
    assert len(osm.block_offsets(path)) == 2
    t = osm.map_tables(osm.read_elements(spark, [path]))
    objects = {(r.object_type, r.object_id): r for r in t["objects"].collect()}
    n = objects["node", 10]
    assert (n.version, n.visible, n.changeset, n.uid, n.user, round(n.latitude, 7), round(n.longitude, 7), n.timestamp) == (1, True, 7, 3, "ana", 40.0, -3.7, "1970-01-01 00:16:40+00:00")
    assert objects["node", 15].visible is False and objects["node", 15].latitude is None and objects["way", 77].version == 4
    assert rows(t["tags"]) == [("node", 10, 1, "name", "Casa"), ("way", 77, 4, "name", "Casa")]
    assert rows(t["way_nodes"]) == [(77, 4, 0, 10), (77, 4, 1, 15), (77, 4, 2, 10)]
    assert rows(t["relation_members"]) == [(88, 4, 0, "w", 77, "outer"), (88, 4, 1, "n", 10, "")]
