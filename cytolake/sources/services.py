"""Look-ups in web services, and a table of citations. fetch(url) -> parsed JSON can be replaced; errors give empty answers."""

from __future__ import annotations

import json
import re
import urllib.parse
import urllib.request
from collections.abc import Callable

Fetch = Callable[[str], object]
STUDIES = "https://www.cbioportal.org/api/studies"
WORKS = "https://api.crossref.org/works/"


def get_json(url: str, timeout: float = 20) -> object:
    with urllib.request.urlopen(urllib.request.Request(url, headers={"Accept": "application/json"}), timeout=timeout) as r:
        return json.load(r)


def studies(keyword: str, fetch: Fetch = get_json, url: str = STUDIES) -> list[dict]:
    """studyId, name, samples of the studies whose id or name holds the keyword, in any case, by id."""
    try:
        got = fetch(url + "?" + urllib.parse.urlencode({"keyword": keyword, "projection": "DETAILED"}))
    except Exception:  # a service that does not answer has no studies
        return []
    rows = [{"studyId": str(x.get("studyId", "")), "name": str(x.get("name", "")), "samples": int(x.get("allSampleCount") or 0)} for x in got if isinstance(x, dict)] if isinstance(got, list) else []
    return sorted((x for x in rows if keyword.lower() in (x["studyId"] + " " + x["name"]).lower()), key=lambda x: x["studyId"])


def citation(doi: str, fetch: Fetch = get_json, url: str = WORKS) -> dict[str, str]:
    """doi, title, authors (the first, and others), journal, year; Unknown where the service does not tell."""
    out = {"doi": doi, "title": "Unknown", "authors": "Unknown", "journal": "Unknown", "year": "Unknown"}
    try:
        m = fetch(url + urllib.parse.quote(doi))["message"]
        names = [a.get("family") or a.get("name") or "" for a in m.get("author", [])]
        out["title"] = (m.get("title") or ["Unknown"])[0]
        out["authors"] = (names[0] + (" et al." if len(names) > 1 else "")) if names and names[0] else "Unknown"
        out["journal"] = (m.get("container-title") or ["Unknown"])[0]
        out["year"] = str(m["issued"]["date-parts"][0][0])
    except Exception:
        pass
    return out


def citation_table(rows: list[dict[str, str]]) -> str:
    cell = lambda x: str(x).replace("|", "\\|").replace("\n", " ")
    head = "| DOI | Title | Authors | Journal | Year |\n|-|-|-|-|-|"
    return "\n".join([head, *(f"| {' | '.join(cell(r[k]) for k in ('doi', 'title', 'authors', 'journal', 'year'))} |" for r in rows)])


def rewrite_section(markdown: str, heading: str, body: str) -> str:
    """The text with what stands under a heading replaced, up to the next heading of its level or above; the section is added if it is not there."""
    level = len(heading) - len(heading.lstrip("#"))
    found = re.search(rf"(?m)^{re.escape(heading)}[ \t]*$", markdown)
    if not found:
        return f"{markdown.rstrip()}\n\n{heading}\n\n{body}\n"
    after = re.search(rf"(?m)^#{{1,{level}}} ", markdown[found.end() :])
    rest = markdown[found.end() + after.start() :] if after else ""
    return f"{markdown[: found.end()]}\n\n{body}\n" + (f"\n{rest}" if rest else "")
