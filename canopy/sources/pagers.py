"""Pagers over an injected get(url) -> bytes; sequential by nature, so they run on the driver.

They yield pages as they come; nothing is held. A missing page is Missing, a
failure worth another try is Transient.
"""

from __future__ import annotations

import json
import re
import time
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from urllib.parse import urlencode, urljoin

Get = Callable[[str], bytes]
ATTEMPTS, BASE, CAP, PACE, PAGE = 8, 1.0, 30.0, 0.2, 100
SHORT_PAGE = 200


class Transient(Exception):
    pass


class Missing(Exception):
    pass


def with_retries(get: Get, url: str, attempts: int = ATTEMPTS, sleep: Callable[[float], None] = time.sleep) -> bytes:
    for k in range(1, attempts + 1):
        try:
            return get(url)
        except Transient:
            if k == attempts:
                raise
            sleep(min(BASE * 2 ** (k - 1), CAP))
    raise AssertionError


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def sru_page(body: bytes) -> tuple[int, list[str]]:
    """Total and records of a response; bad XML is not worth another try."""
    root = ET.fromstring(body)
    total = next((int(e.text or 0) for e in root.iter() if _local(e.tag) == "numberOfRecords"), 0)
    return total, [ET.tostring(e, encoding="unicode") for e in root.iter() if _local(e.tag) == "recordData"]


def sru(get: Get, endpoint: str, query: str, page: int = PAGE, pace: float = PACE, sleep=time.sleep) -> Iterator[str]:
    """All records: on by as many as came, until a page is empty or the total is passed."""
    start = 1
    while True:
        total, records = sru_page(with_retries(get, sru_url(endpoint, query, start, page), sleep=sleep))
        yield from records
        start += len(records)
        if not records or start > total:
            return
        sleep(pace)


def sru_span(get: Get, endpoint: str, query: str, start: int, end: int, page: int = PAGE, pace: float = PACE, sleep=time.sleep) -> Iterator[str]:
    """Records start to end - 1, on by as many as came."""
    while start < end:
        _, records = sru_page(with_retries(get, sru_url(endpoint, query, start, min(page, end - start)), sleep=sleep))
        yield from records[: end - start]
        start += len(records)
        if not records:
            return
        if start < end:
            sleep(pace)


def sru_url(endpoint: str, query: str, start: int, page: int = PAGE) -> str:
    return f"{endpoint}?{urlencode({'version': '2.0', 'operation': 'searchRetrieve', 'startRecord': start, 'maximumRecords': page, 'query': query})}"


def lower_bound_query(base: str, since: str) -> str:
    return f"{base} and dt.available>={since}"


def hal(get: Get, url: str, sleep=time.sleep) -> Iterator[dict]:
    """Pages along _links.next.href, taken as they are."""
    while url:
        page = json.loads(with_retries(get, url, sleep=sleep))
        yield page
        url = ((page.get("_links") or {}).get("next") or {}).get("href")


def numbered(get: Get, url: str, key: str, short: int = SHORT_PAGE, sleep=time.sleep) -> Iterator[list[dict]]:
    """Numbered pages until one is short."""
    k = 1
    while True:
        rows = (json.loads(with_retries(get, f"{url}{'&' if '?' in url else '?'}page={k}", sleep=sleep)).get("_embedded") or {}).get(key) or []
        yield rows
        if len(rows) < short:
            return
        k += 1


def atom_download(get: Get, url: str, hops: int = 3) -> str:
    """The archive an Atom feed leads to, through at most hops feeds; an archive link wins over a feed's."""
    for _ in range(hops):
        links = [urljoin(url, e.attrib.get("href", "")) for e in ET.fromstring(get(url)).iter() if _local(e.tag) == "link"]
        archive = next((x for x in links if re.search(r"\.zip($|\?)", x)), None)
        if archive:
            return archive
        url = next((x for x in links if re.search(r"\.(xml|atom)($|\?)", x) and x != url), "")
        if not url:
            break
    raise Missing("no archive in the feed")


def wfs_url(endpoint: str, layer: str, field: str, value: str, count: int = 10_000) -> str:
    rule = f"<Filter><PropertyIsEqualTo><PropertyName>{field}</PropertyName><Literal>{value}</Literal></PropertyIsEqualTo></Filter>"
    return f"{endpoint}?{urlencode({'service': 'WFS', 'version': '2.0.0', 'request': 'GetFeature', 'typeNames': layer, 'outputFormat': 'application/json', 'count': count, 'filter': rule})}"


def sidecars(get: Get, ids: Iterator[tuple[str, str]], needed: Callable[[str], bool], breaker: int = 2, sleep=time.sleep) -> Iterator[tuple[str, bytes | None]]:
    """(id, sidecar) where one is needed; absent ones are None. After breaker exhausted ids in a row the rest are left; 0 never trips."""
    failed = 0
    for name, url in ids:
        if not needed(name):
            continue
        if breaker and failed >= breaker:
            return
        try:
            yield name, with_retries(get, url, sleep=sleep)
            failed = 0
        except Missing:
            yield name, None
            failed = 0
        except Transient:
            failed += 1


def select_sources(registry: list[str], named: list[str]) -> list[str]:
    """All in registry order when none is named; else as named; unknown names fail."""
    unknown = [n for n in named if n not in registry]
    if unknown:
        raise ValueError(f"unknown sources: {', '.join(unknown)}")
    return list(named) or list(registry)
