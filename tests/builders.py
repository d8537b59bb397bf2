"""Responses for tests."""

from __future__ import annotations

import datetime as dt

from pagemill.schemas import RESPONSE_SCHEMA

PAGE = (
    "<html><head><script>x()</script></head><body>Hello <b>A</b></body></html>"
)
HTML = "text/html; charset=utf-8"


def response(seq, url, body=PAGE, kind=HTML, status=200, request_url=None, redirects=(), error=None):
    return {
        "seq": seq,
        "request_url": request_url or url,
        "url": url,
        "redirect_urls": list(redirects),
        "status": None if error else status,
        "headers": {} if error or kind is None else {"Content-Type": kind},
        "body": None if error else body.encode() if isinstance(body, str) else body,
        "error": error,
        "failure_type": "TimeoutError" if error else None,
        "fetched_at": dt.datetime(2026, 1, 1) + dt.timedelta(seconds=seq),
    }


def responses(spark, *rows):
    names = RESPONSE_SCHEMA.names
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], RESPONSE_SCHEMA)
