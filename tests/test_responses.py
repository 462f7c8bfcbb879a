"""The source of responses against a local server: once a url, cookies, pace, the age gate, settings of a run."""

import dataclasses
import os
import signal
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from vitrine.plans import chains, config
from vitrine.sources import fetched
from vitrine.sources.responses import landed, responses


class Site:
    """A server that notes what is asked for; pages is a function from (path, headers) to (status, headers, body)."""

    def __init__(self, pages):
        self.seen = []
        site = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                site.seen.append((self.path, dict(self.headers), time.monotonic()))
                status, headers, body = pages(self)
                self.send_response(status)
                for k, v in headers:
                    self.send_header(k, v)
                self.end_headers()
                self.wfile.write(body.encode())

            def log_message(self, *a):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.base = f"http://127.0.0.1:{self.server.server_port}"

    def paths(self):
        return [p for p, _, _ in self.seen]


@pytest.fixture
def site():
    made = []

    def make(pages):
        made.append(Site(pages))
        return made[-1]

    yield make
    for s in made:
        s.server.shutdown()


def urls(spark, base, *paths):
    return spark.createDataFrame([(f"{base}{x}" if x.startswith("/") else x,) for x in paths], "url string")


def test_bodies_redirects_failures(spark, site, tmp_path):
    def pages(h):
        tries = Counter(s.paths())
        if h.path == "/moved":
            return 302, [("Location", "/ok")], ""
        if h.path == "/busy" and tries["/busy"] < 2:
            return 503, [], ""
        return (200 if h.path in ("/ok", "/busy") else 404), [("Content-Type", "text/html; charset=cp1251")] if h.path == "/busy" else [], h.headers.get("X-A", "")

    s = site(pages)
    asked = urls(spark, s.base, "/ok", "/ok", "/moved", "/none", "/busy", "bad", "http://[").unionByName(spark.createDataFrame([(None,)], "url string"))
    df = fetched.fetch(asked, landing=str(tmp_path / "l"), retries=1, headers={"X-A": "a"})
    got = {r.url.removeprefix(s.base): r for r in df.collect()}
    assert (got["/ok"].body, got["/moved"].final_url, got["/none"].status, got["/none"].body, got["bad"].error) == ("a", f"{s.base}/ok", 404, None, "ValueError")
    assert (got["/busy"].status, got["/busy"].error) == (200, None) and got["http://["].error == "ValueError"
    assert Counter(s.paths()) == {"/ok": 2, "/moved": 1, "/none": 1, "/busy": 2}  # /ok also as the redirect's target
    assert len(got) == 6 and df.count() == 6 and len(s.seen) == 6  # a second action requests nothing


def test_killed_task_requests_nothing_twice(spark, site, tmp_path):
    """The worker is killed while it waits for the fourth response; the run that follows asks for that one and the rest."""
    psutil = pytest.importorskip("psutil")
    killed = []

    def pages(h):
        if h.path == "/3" and not killed:
            me = h.client_address[1]
            pid = next(c.pid for c in psutil.net_connections("tcp") if c.laddr.port == me and c.pid)
            assert pid != os.getpid()
            killed.append(pid)
            os.kill(pid, signal.SIGKILL)
        return 200, [], h.path

    s = site(pages)
    asked = urls(spark, s.base, *[f"/{i}" for i in range(8)]).coalesce(1)
    df = responses(asked, str(tmp_path / "l"), retries=0)
    with pytest.raises(Exception):
        df.collect()
    assert killed
    before = set(s.paths())
    assert sorted(r.body for r in df.collect()) == [f"/{i}" for i in range(8)]
    assert Counter(s.paths()) == {f"/{i}": 2 if i == 3 else 1 for i in range(8)} and len(before) < 8
    assert landed(spark, str(tmp_path / "l")).count() == 8


def test_a_line_cut_off_is_requested_again(spark, site, tmp_path):
    s = site(lambda h: (200, [], "x" * 50))
    df = responses(urls(spark, s.base, "/a"), str(tmp_path / "l"))
    assert df.count() == 1
    (file,) = (tmp_path / "l").glob("slot=*/*.jsonl")
    file.write_bytes(file.read_bytes()[:-30])
    assert df.first().body == "x" * 50 and s.paths() == ["/a", "/a"]


def test_same_run_other_query_and_other_headers(spark, site, tmp_path):
    s = site(lambda h: (200, [], h.headers.get("Referer", "")))
    land = str(tmp_path / "l")
    assert responses(urls(spark, s.base, "/a", "/b"), land).count() == 2
    assert responses(urls(spark, s.base, "/b", "/c"), land).count() == 2
    assert Counter(s.paths()) == {"/a": 1, "/b": 1, "/c": 1}
    assert responses(urls(spark, s.base, "/a"), land, headers={"Referer": "r"}).first().body == "r"
    assert responses(urls(spark, s.base).limit(0), land).count() == 0


def test_cookies_of_a_host_and_its_pace(spark, site, tmp_path):
    def pages(h):
        return 200, [("Set-Cookie", f"n{h.path[1:]}=1; Path=/")], h.headers.get("Cookie", "")

    s = site(pages)
    bodies = [r.body for r in responses(urls(spark, s.base, "/a", "/b", "/c"), str(tmp_path / "l"), pace=0.2, cookies={"k": "v"}).collect()]
    assert sorted(len(b.split("; ")) for b in bodies) == [1, 2, 3] and all("k=v" in b for b in bodies)
    times = [t for _, _, t in s.seen]
    assert all(b - a >= 0.12 for a, b in zip(times, times[1:]))


def test_age_gate_asks_for_the_first_page(spark, site, tmp_path):
    """The map page, then the site's first page with the cookies of age, then the map page with those and the site's own."""
    def pages(h):
        got = h.headers.get("Cookie", "")
        if h.path == "/":
            return (200, [("Set-Cookie", "ticket=7; Path=/")], "") if "is_adult=1" in got else (403, [], "")
        if h.path == "/map/" and "ticket=7" in got and "age=18" in got:
            return 200, [], '<script src="/s.js"></script>'
        if h.path == "/s.js" and "age=18" in got:
            return 200, [], 'var shops = [{"address": "пр. Новый, 8", "city": "Бийск", "lat": 52.5, "lng": 85.25}];'
        return 200, [], "Вам есть 18?"

    s = site(pages)
    cfg = dataclasses.replace(config.from_env(), maria_ra_url=s.base, maria_ra_map_url=f"{s.base}/map/", retries=0, landing=str(tmp_path / "l"))
    rows = chains.maria_ra(spark, cfg, None).collect()
    assert [(r.city, r.latitude) for r in rows] == [("Бийск", 52.5)]
    assert s.paths()[:3] == ["/map/", "/", "/map/"] and s.paths().count("/map/") == 2


def test_settings(monkeypatch):
    monkeypatch.setenv("STORE_PARSER_PACE", "0.5")
    monkeypatch.setenv("STORE_PARSER_LANDING", " /x ")
    assert (config.from_env().pace, config.from_env().landing) == (0.5, "/x")
    for bad in ("-1", "inf", "nan", "z"):
        monkeypatch.setenv("STORE_PARSER_PACE", bad)
        assert config.from_env().pace == 0
    monkeypatch.setenv("STORE_PARSER_TIMEOUT", "0")
    monkeypatch.setenv("STORE_PARSER_RETRIES", "x")
    assert (config.from_env().timeout, config.from_env().retries) == (20, 3)


def test_env_file(monkeypatch, tmp_path):
    monkeypatch.setenv("STORE_PARSER_OUTPUT", "kept.xlsx")
    monkeypatch.delenv("STORE_PARSER_LOG_LEVEL", raising=False)
    (tmp_path / ".env").write_text('# a note\nSTORE_PARSER_OUTPUT=lost.xlsx\nSTORE_PARSER_LOG_LEVEL = "debug"\nnothing\n')
    config.load_env_file(str(tmp_path / ".env"))
    config.load_env_file(str(tmp_path / "none"))
    assert (config.from_env().output, config.from_env().log_level) == ("kept.xlsx", "DEBUG")
    monkeypatch.delenv("STORE_PARSER_LOG_LEVEL")


def test_upper_case_items_of_one_mall(spark):
    """D4 over the chain: items without coordinates whose NAMEs differ all stay."""
    cfg = config.from_env()
    names = ["г. Бийск, ул. Новая, 1", "г. Бийск, ул. Новая, 2", "г. Рубцовск, ул. Старая, 3", "г. Бийск, ул. Новая, 1"]
    body = "<script>var shops = [" + ",".join(f'{{"NAME": "{n}", "STARTED_WORK": "8", "END_WORK": "22"}}' for n in names) + "];</script>"
    table = spark.createDataFrame([(cfg.maria_ra_map_url, 200, cfg.maria_ra_map_url, body)], "url string, status int, final_url string, body string")
    rows = chains.maria_ra(spark, cfg, table).select("city", "address", "work_time").where(F.col("work_time").isNotNull()).collect()
    assert len({(r.city, r.address) for r in rows}) == 3 == len(rows)
