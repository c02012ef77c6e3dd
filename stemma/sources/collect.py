"""Collectors: polite, resumable fetching on the driver, around an exchangeable ``fetch``.

The engine opens no connections itself. A fetcher is a function of a URL that gives (status, body) and raises OSError where
no answer comes. What has been collected is read back by the sources of ``raw``.
"""

from __future__ import annotations

import datetime
import gzip
import json
import os
import time
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import unquote

Fetch = Callable[[str], tuple[int, bytes]]

#: Seconds between requests, the factor after a blocked one, and how many in a row end a run.
DELAY, BLOCKED_FACTOR, MOST_BLOCKED, MOST_ERRORS = 1.0, 30, 5, 20
BLOCKED = (403, 429)
#: Titles in one request to a MediaWiki, and what it is asked for.
TITLES_AT_ONCE = 50
WIKI_QUERY = {
    "action": "query",
    "format": "json",
    "formatversion": "2",
    "redirects": "1",
    "prop": "revisions|pageprops|info",
    "rvprop": "content|timestamp|ids",
    "rvslots": "main",
    "ppprop": "wikibase_item",
    "inprop": "url",
}


def write_body(path: str, body: bytes, compress: bool = False) -> None:
    """An answer as it came. The file appears whole or not at all."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(f"{path}.part", "wb") as f:
        f.write(gzip.compress(body) if compress else body)
    os.replace(f"{path}.part", path)


def cached(fetch: Callable[[str, int], tuple[str, int]], folder: str) -> Callable[[str, int], tuple[str, int]]:
    """A listing fetcher (category, page) -> (body, pages) that asks for nothing twice: answers are kept in ``folder``."""

    def get(category: str, page: int) -> tuple[str, int]:
        path = os.path.join(folder, f"{category}_{page:03d}.json")
        if os.path.exists(path):
            with open(path, encoding="utf-8") as f:
                kept = json.load(f)
            return kept["body"], kept["pages"]
        body, pages = fetch(category, page)
        write_body(path, json.dumps({"body": body, "pages": pages}, ensure_ascii=False).encode())
        return body, pages

    return get


def crawl(candidates: Iterable[tuple[str, str]], fetch: Fetch, folder: str, wanted: Callable[[str], bool] = lambda _: True, limit: int = 0, delay: float = DELAY, sleep: Callable[[float], None] = time.sleep) -> dict[str, int]:
    """Fetch (page_id, url) candidates into ``folder``/pages as gzip, with a line for each request in fetch_log.jsonl.

    Pages on disk and those logged as without a book are not asked for again. A run ends after MOST_BLOCKED blocked answers
    or MOST_ERRORS failures since the last good one, or after ``limit`` new pages. Returns the counts of the run.
    """
    log_path, counts = os.path.join(folder, "fetch_log.jsonl"), {"new": 0, "blocked": 0, "errors": 0}
    empty: set[str] = set()
    if os.path.exists(log_path):
        with open(log_path, encoding="utf-8") as f:
            empty = {e["page_id"] for e in map(json.loads, f) if e.get("note") == "no_book"}
    os.makedirs(folder, exist_ok=True)
    with open(log_path, "a", encoding="utf-8") as log:
        for page_id, url in candidates:
            path = os.path.join(folder, "pages", f"{page_id}.html.gz")
            if page_id in empty or os.path.exists(path):
                continue
            entry: dict[str, object] = {"page_id": page_id, "url": unquote(url), "fetched_at": datetime.datetime.now().isoformat(timespec="seconds")}
            wait = delay
            try:
                status, body = fetch(url)
                entry |= {"status": status, "bytes": len(body)}
                if status in BLOCKED:
                    counts["blocked"] += 1
                    entry["note"], wait = "blocked", delay * BLOCKED_FACTOR
                elif status != 200:
                    entry["note"] = "http_error"
                else:
                    counts["blocked"] = counts["errors"] = 0
                    if wanted(body.decode("utf-8", "replace")):
                        write_body(path, body, compress=True)
                        counts["new"] += 1
                    else:
                        entry["note"] = "no_book"
            except OSError as e:
                counts["errors"] += 1
                entry |= {"status": None, "error": str(e)[:200]}
            log.write(json.dumps(entry, ensure_ascii=False) + "\n")
            log.flush()
            if counts["blocked"] >= MOST_BLOCKED or counts["errors"] >= MOST_ERRORS or (limit and counts["new"] >= limit):
                break
            sleep(wait)
    return counts


def read_titles(path: str) -> list[str]:
    """A JSON list of page titles."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def wiki_requests(titles: list[str]) -> Iterator[dict[str, str]]:
    """Parameters of the requests for all titles, TITLES_AT_ONCE in each."""
    for at in range(0, len(titles), TITLES_AT_ONCE):
        yield {**WIKI_QUERY, "titles": "|".join(titles[at : at + TITLES_AT_ONCE])}


def wiki_pages(answer: str) -> list[str]:
    """The pages of one answer, each as a line of JSON."""
    return [json.dumps(p, ensure_ascii=False) for p in json.loads(answer)["query"]["pages"]]


def collect_wiki(titles: list[str], ask: Callable[[dict[str, str]], str], path: str, delay: float = DELAY, sleep: Callable[[float], None] = time.sleep) -> int:
    """Write the pages of all titles as JSON lines; returns their number."""
    lines: list[str] = []
    for params in wiki_requests(titles):
        lines += wiki_pages(ask(params))
        sleep(delay)
    write_body(path, "".join(f"{line}\n" for line in lines).encode())
    return len(lines)
