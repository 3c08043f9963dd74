"""Harvest profiles: which links are documents, and how promising a link is."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text, urls

# Weights of tokens in links to module handbooks.
MODULE_POSITIVE = {
    "modulhandbuch": 100, "modulhandbuecher": 100, "module-handbook": 100,
    "modulbeschreibung": 60, "modulkatalog": 60,
    "modul": 25, "module": 20,
    "pruefungsordnung": 35, "studienordnung": 35, "studienplan": 30,
    "curriculum": 30, "ordnung": 12,
    "studiengang": 20, "studiengaenge": 20, "studium": 15, "studies": 10,
    "bachelor": 15, "master": 15, "b-sc": 10, "m-sc": 10,
    "vorlesungsverzeichnis": 20, "lehrveranstaltung": 12, "lehre": 8,
    "fachbereich": 8, "fakultaet": 8, "institut": 5,
    "download": 10, "downloads": 10, "dokumente": 10, "formulare": 6,
    "pdf": 4,
}
MODULE_NEGATIVE = {
    "aktuelles": -40, "news": -40, "presse": -40, "pressemitteilung": -40,
    "veranstaltung": -30, "event": -30, "termine": -20, "kalender": -20,
    "kontakt": -30, "impressum": -60, "datenschutz": -60, "cookie": -50,
    "mensa": -30, "wohnen": -20, "sport": -20, "hochschulsport": -25,
    "stellenangebot": -30, "karriere": -20, "jobs": -20, "stellen": -20,
    "login": -40, "anmeldung": -20, "suche": -25, "search": -25,
    "sitemap": -20, "rss": -25, "feed": -25,
    "english": -15, "/en/": -15,
    "alumni": -20, "spende": -25, "blog": -20, "gremien": -20,
}


@dataclass(frozen=True)
class Profile:
    """Hooks as column expressions."""

    name: str
    extensions: tuple[str, ...] = ()
    positive: dict[str, int] = field(default_factory=dict)
    negative: dict[str, int] = field(default_factory=dict)
    pages: bool = False

    def score(self, url: Column, anchor: Column) -> Column:
        if not self.positive and not self.negative:
            return F.lit(0)
        return text.keyword_score(url, anchor, self.positive, self.negative)

    def is_target(self, url: Column) -> Column:
        return urls.is_target(url, self.extensions)

    def is_target_response(self, content_type: Column) -> Column:
        ext = urls.content_type_extension(content_type)
        return ext.isin(*self.extensions) if self.extensions else F.lit(False)

    def with_extensions(self, extensions: list[str]) -> Profile:
        """Other document endings, with or without a dot, in any case; none given: unchanged."""
        own = tuple(dict.fromkeys("." + e.strip().lower().lstrip(".") for e in extensions if e and e.strip(". ")))
        return Profile(self.name, own, self.positive, self.negative, self.pages) if own else self


PROFILES = {
    "modulhandbuch": Profile("modulhandbuch", (".pdf", ".doc", ".docx"), MODULE_POSITIVE, MODULE_NEGATIVE),
    "html": Profile("html", pages=True),
}
DEFAULT = "modulhandbuch"


def available_profiles() -> list[str]:
    return sorted(PROFILES)


def get_profile(name: str | None) -> Profile:
    """The profile of this name, trimmed and in any case; the default one for any other."""
    return PROFILES.get((name or "").strip().lower(), PROFILES[DEFAULT])


# The selectable file types by group.
FILE_TYPES = {
    "Dokument": [("pdf", "PDF"), ("doc", "Word (.doc)"), ("docx", "Word (.docx)"), ("xls", "Excel (.xls)"), ("xlsx", "Excel (.xlsx)"),
                 ("ppt", "PowerPoint (.ppt)"), ("pptx", "PowerPoint (.pptx)"), ("odt", "OpenDocument Text"), ("ods", "OpenDocument Sheet"),
                 ("odp", "OpenDocument Präsentation"), ("rtf", "Rich Text (.rtf)"), ("txt", "Text (.txt)"), ("csv", "CSV")],
    "Bild": [("jpg", "JPEG (.jpg)"), ("jpeg", "JPEG (.jpeg)"), ("png", "PNG"), ("gif", "GIF"), ("bmp", "BMP"), ("tiff", "TIFF"), ("svg", "SVG"), ("webp", "WebP")],
    "Media": [("mp3", "MP3"), ("wav", "WAV"), ("flac", "FLAC"), ("aac", "AAC"), ("ogg", "OGG"), ("mp4", "MP4"), ("avi", "AVI"), ("mov", "MOV"), ("mkv", "MKV"),
              ("webm", "WebM"), ("wmv", "WMV")],
}


def file_types(spark):
    """(group, ext, label): the catalogue as a table."""
    return spark.createDataFrame([(g, e, n) for g, xs in FILE_TYPES.items() for e, n in xs], "file_group string, ext string, label string")
