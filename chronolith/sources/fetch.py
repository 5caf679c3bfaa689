"""Fetching archives with their checksums over an injected transport."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from typing import NamedTuple
from urllib.parse import urljoin, urlsplit

from chronolith.sources.archives import MOST_BYTES, SourceError, parse_checksum, verify_digest

# fixed values: retry policy
TRIES = 3
RETRY_STATUS = (429, 502, 503, 504)
MOST_REDIRECTS = 5


class Response(NamedTuple):
    status: int
    headers: dict[str, str]
    body: bytes


Transport = Callable[[str], Response]


def classify(error: BaseException) -> str:
    """retry, timeout or fatal, by the kind of a transport error."""
    if isinstance(error, TimeoutError):
        return "timeout"
    return "retry" if isinstance(error, ConnectionError | InterruptedError) else "fatal"


def _permitted(url: str, hosts: frozenset[str]) -> str:
    parts = urlsplit(url)
    if parts.scheme != "https" or parts.hostname not in hosts or parts.username or parts.port not in (None, 443):
        raise SourceError("url_not_permitted", url)
    return url


def fetch(url: str, transport: Transport, hosts: frozenset[str], sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random) -> bytes:
    """The body of an https URL on an allowed host.

    Up to three tries, waiting 1, 2, 4 seconds and a jitter after connection
    errors and retryable statuses; redirects stay on allowed hosts.
    """
    for attempt in range(TRIES):
        target, hops = _permitted(url, hosts), 0
        try:
            answer = transport(target)
            while answer.status in (301, 302, 303, 307, 308):
                hops += 1
                if hops > MOST_REDIRECTS:
                    raise SourceError("too_many_redirects", url)
                target = _permitted(urljoin(target, answer.headers.get("location", "")), hosts)
                answer = transport(target)
        except OSError as error:
            if classify(error) == "fatal" or attempt == TRIES - 1:
                raise SourceError(f"transport_{classify(error)}", url) from error
        else:
            if answer.status == 200:
                if len(answer.body) > MOST_BYTES:
                    raise SourceError("body_too_large", url)
                return answer.body
            if answer.status not in RETRY_STATUS or attempt == TRIES - 1:
                raise SourceError("http_status", f"{answer.status} {url}")
        sleep(2**attempt + jitter())
    raise AssertionError("unreachable")


def fetch_verified(url: str, transport: Transport, hosts: frozenset[str], **how) -> tuple[bytes, str]:
    """An archive whose bytes match its checksum document; also the digest."""
    name = urlsplit(url).path.rsplit("/", 1)[-1]
    digest = parse_checksum(fetch(f"{url}.CHECKSUM", transport, hosts, **how).decode("ascii"), name)
    data = fetch(url, transport, hosts, **how)
    verify_digest(data, digest)
    return data, digest


def read_range(transport_range: Callable[[int, int], bytes], start: int, size: int, crc32: int, sha256: str) -> bytes:
    """One deflated member of a large archive by its pinned byte range."""
    import zlib

    raw = transport_range(start, size)
    out = zlib.decompress(raw, -15)
    if zlib.crc32(out) != crc32:
        raise SourceError("archive_corrupt", "crc32")
    verify_digest(out, sha256)
    return out


def read_local(path: str, size: int) -> bytes:
    """A local archive of a pinned size that does not change while it is read."""
    import os

    before = os.stat(path)
    if before.st_size != size:
        raise SourceError("local_size", str(before.st_size))
    with open(path, "rb") as f:
        data = f.read()
    after = os.stat(path)
    if (before.st_mtime_ns, before.st_size, before.st_ino) != (after.st_mtime_ns, after.st_size, after.st_ino) or len(data) != size:
        raise SourceError("changed_during_read", path)
    return data
