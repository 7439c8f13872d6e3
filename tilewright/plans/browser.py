"""Offline pages over results: one for a slide, one for a batch."""

from __future__ import annotations

import html
from collections.abc import Iterable

STYLE = "body{font:14px sans-serif;margin:2em}td,th{padding:.3em .8em;border-bottom:1px solid #ccc;text-align:left}.failed{color:#b00}.completed{color:#070}"


def text(value) -> str:
    """A value as safe page text; nothing is a dash."""
    if value is None:
        return "&ndash;"
    return html.escape(f"{value:.4g}" if isinstance(value, float) else str(value))


def page(title: str, body: str) -> str:
    return f"<!doctype html><meta charset=utf-8><title>{text(title)}</title><style>{STYLE}</style><h1>{text(title)}</h1>{body}"


def table(rows: Iterable[dict], columns: list[str]) -> str:
    head = "".join(f"<th>{text(c)}</th>" for c in columns)
    body = "".join("<tr class='" + text(r.get("state") or "") + "'>" + "".join(f"<td>{text(r.get(c))}</td>" for c in columns) + "</tr>" for r in rows)
    return f"<table><tr>{head}</tr>{body}</table>"


def report_page(report: dict) -> str:
    """The measurements of one report, section by section."""
    parts = []
    for name, section in report.items():
        rows = [{"field": k, "value": v} for k, v in section.items() if not isinstance(v, (bytes, bytearray))] if isinstance(section, dict) else [{"field": name, "value": section}]
        parts.append(f"<h2>{text(name)}</h2>" + table(rows, ["field", "value"]))
    return page(str(report.get("slide", "report")), "".join(parts))


def batch_page(batch_id: str, rows: Iterable[dict]) -> str:
    return page(f"Batch {batch_id}", table(rows, ["slide", "job_key", "state", "stage", "error_type", "message"]))
