"""A Spark data source of web responses, `vitrine_responses`: each url of a run is requested once and lands in a table.

Urls are dealt by host into slots, a slot is a partition: a host's requests come from one task, in order, with one cookie jar and at its pace. Every
response is appended, as soon as it is there, to a file of JSON lines in the landing folder, under the slot. A task that runs again, and any later query or run with
the same landing folder, reads what has landed and requests only what is missing. So a lost executor costs at most the request that it
was waiting for. With speculation on, two copies of a task may request the same; both land and one counts.

The landing folder can be anywhere that pyarrow.fs and Spark both reach. A task holds 16 bytes a url that it is asked for, not the responses.
"""

from __future__ import annotations

import hashlib
import json
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Iterator
from http.cookiejar import Cookie, CookieJar
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# --- fixed values: when and how often a request is repeated ---------------------------------------------------------
RETRY_STATUSES, BACKOFF = [429, 500, 502, 503, 504], 0.5
# ------------------------------------------------------------------------------------------------------------------
SCHEMA = "url string, status int, final_url string, body string, error string"
FIELDS = [x.split()[0] for x in SCHEMA.split(", ")]
SLOTS = 16


def _cookie(host: str, name: str, value: str) -> Cookie:
    return Cookie(0, name, value, None, False, host, False, False, "/", True, False, None, True, None, None, {})


class Session:
    """Requests of one slot: a cookie jar, cookies that each host starts with, a page that is asked for first, a pace a host."""

    def __init__(self, *, timeout: float = 20, retries: int = 3, headers: dict | None = None, cookies: dict | None = None, prime: str | None = None, pace: float = 0) -> None:
        self.timeout, self.retries, self.headers, self.cookies, self.prime, self.pace = timeout, retries, headers or {}, cookies or {}, prime, pace
        self.jar = CookieJar()
        self.opener = urllib.request.build_opener(urllib.request.HTTPCookieProcessor(self.jar))
        self.last: dict[str, float] = {}

    def _open(self, url: str, host: str) -> tuple[int, str, str]:
        wait = self.last.get(host, -1e9) + self.pace - time.monotonic()
        if wait > 0:
            time.sleep(wait)
        try:
            with self.opener.open(urllib.request.Request(url, headers=self.headers), timeout=self.timeout) as r:
                return r.status, r.url, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")
        finally:
            self.last[host] = time.monotonic()  # the pace counts from the end of a request

    def get(self, url: str) -> dict:
        """S1-S3, S7. One response as a row of SCHEMA; failures that may pass are repeated with growing pauses."""
        row = dict.fromkeys(FIELDS) | {"url": url}
        try:
            host = urlsplit(url).hostname or ""
        except ValueError:
            host = ""
        if host and host not in self.last:
            for name, value in self.cookies.items():
                self.jar.set_cookie(_cookie(host, name, value))
            if self.prime and urlsplit(self.prime).hostname == host:
                try:
                    self._open(self.prime, host)
                except (OSError, ValueError):
                    pass  # what counts are the cookies that it may set
        for i in range(self.retries + 1):
            try:
                status, final, body = self._open(url, host)
                return row | {"status": status, "final_url": final, "body": body, "error": None}
            except urllib.error.HTTPError as e:
                row |= {"status": e.code, "error": f"HTTP {e.code}"}
                if e.code not in RETRY_STATUSES:
                    break
            except ValueError as e:
                row |= {"error": type(e).__name__}
                break
            except OSError as e:
                row |= {"error": type(e).__name__}
            if i < self.retries:
                time.sleep(BACKOFF * 2**i)
        return row


def _filesystem(path: str):
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def _lines(folder: str) -> Iterator[dict]:
    """Rows of the JSON lines under a folder; a line that its writer didn't finish is passed over."""
    from pyarrow import fs

    system, root = _filesystem(folder)
    for info in sorted(system.get_file_info(fs.FileSelector(root, allow_not_found=True)), key=lambda x: x.path):
        if info.is_file and info.base_name.endswith((".json", ".jsonl")):
            import io

            with system.open_input_stream(info.path) as f:
                for line in io.BufferedReader(f):
                    try:
                        yield json.loads(line)
                    except ValueError:
                        continue


class Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.asked, self.landing, self.slots, self.settings = options["asked"], options["landing"], int(options["slots"]), options["settings"]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(k) for k in range(self.slots)]

    def key(self, url: str) -> str:
        """What a response lands under: the url and all that is sent with it."""
        sent = {k: v for k, v in json.loads(self.settings).items() if k in ("headers", "cookies", "prime")}
        return hashlib.md5(json.dumps([url, sent], sort_keys=True).encode(), usedforsecurity=False).hexdigest()

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        asked, landed = f"{self.asked}/slot={partition.value}", f"{self.landing}/slot={partition.value}"
        missing = {bytes.fromhex(self.key(x["url"])) for x in _lines(asked)}
        if not missing:
            return
        for row in _lines(landed):
            if (key := bytes.fromhex(row["key"])) in missing:
                missing.discard(key)
                yield tuple(row.get(f) for f in FIELDS)
        if not missing:
            return
        session = Session(**json.loads(self.settings))
        system, root = _filesystem(landed)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/{uuid.uuid4().hex}.jsonl") as out:
            for x in _lines(asked):
                key = self.key(x["url"])
                if bytes.fromhex(key) in missing:
                    missing.discard(bytes.fromhex(key))
                    row = session.get(x["url"])
                    out.write((json.dumps(row | {"key": key}, ensure_ascii=False) + "\n").encode())
                    out.flush()
                    yield tuple(row[f] for f in FIELDS)


class Responses(DataSource):
    """Options: asked (folder of urls by slot), landing, slots, settings (arguments of Session as JSON)."""

    @classmethod
    def name(cls) -> str:
        return "vitrine_responses"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)


def responses(urls: DataFrame, landing: str, *, slots: int = SLOTS, **settings) -> DataFrame:
    """Rows of SCHEMA for the distinct urls (url) of a table, requested where the tasks run; null urls are left out. settings as Session has them.

    slots must stay the same for a landing folder, as a url's slot is looked up by its host.
    """
    spark: SparkSession = urls.sparkSession
    spark.dataSource.register(Responses)
    asked = f"{landing}/_asked-{uuid.uuid4().hex}"
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    dealt = urls.select("url").where("url is not null").distinct().withColumn("slot", F.pmod(F.crc32(host.cast("binary")), F.lit(slots)).cast("int"))
    dealt.repartition(slots, "slot").write.partitionBy("slot").json(asked)
    return spark.read.format("vitrine_responses").options(asked=asked, landing=landing, slots=slots, settings=json.dumps(settings)).load()


def landed(spark: SparkSession, landing: str) -> DataFrame:
    """What has landed, as a table of responses; a run can read it instead of fetching."""
    return spark.read.schema(SCHEMA).option("mode", "DROPMALFORMED").json(f"{landing}/slot=*")
