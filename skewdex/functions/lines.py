"""Line-prefix markers and cutting the body out of a text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line prefixes after which the body of a stored book starts.
START_MARKERS = (
    "*END*THE SMALL PRINT",
    "*** START OF THE PROJECT GUTENBERG",
    "*** START OF THIS PROJECT GUTENBERG",
    "This etext was prepared by",
    "E-text prepared by",
    "Produced by",
    "Distributed Proofreading Team",
    "Proofreading Team at http://www.pgdp.net",
    "http://gallica.bnf.fr)",
    "      http://archive.org/details/",
    "http://www.pgdp.net",
    "by The Internet Archive)",
    "by The Internet Archive/Canadian Libraries",
    "by The Internet Archive/American Libraries",
    "public domain material from the Internet Archive",
    "Internet Archive)",
    "Internet Archive/Canadian Libraries",
    "Internet Archive/American Libraries",
    "material from the Google Print project",
    "*END THE SMALL PRINT",
    "***START OF THE PROJECT GUTENBERG",
    "This etext was produced by",
    "*** START OF THE COPYRIGHTED",
    "http://gutenberg.spiegel.de/ erreichbar.",
    "Project Runeberg publishes",
    "Beginning of this Project Gutenberg",
    "Project Gutenberg Online Distributed",
    "Gutenberg Online Distributed",
    "the Project Gutenberg Online Distributed",
    "Project Gutenberg TEI",
    "This eBook was prepared by",
    "http://gutenberg2000.de erreichbar.",
    "This Etext was prepared by",
    "This Project Gutenberg Etext was prepared by",
    "Gutenberg Distributed Proofreaders",
    "Project Gutenberg Distributed Proofreaders",
    "the Project Gutenberg Online Distributed Proofreading Team",
    "**The Project Gutenberg",
    "*SMALL PRINT!",
    "More information about this book is at the top of this file.",
    "tells you about restrictions in how the file may be used.",
    "l'authorization",
    "of the etext through OCR.",
    "*****These eBooks Were Prepared By Thousands of Volunteers!*****",
    "We need your donations more than ever!",
    " *** START OF THIS PROJECT GUTENBERG",
    "****     SMALL PRINT!",
    '["Small Print" V.',
    "      (http://www.ibiblio.org/gutenberg/",
    "and the Project Gutenberg Online Distributed Proofreading Team",
    "Mary Meehan, and the Project Gutenberg Online Distributed Proofreading",
    "                this Project Gutenberg edition.",
)

# Line prefixes at which the body ends.
END_MARKERS = (
    "*** END OF THE PROJECT GUTENBERG",
    "*** END OF THIS PROJECT GUTENBERG",
    "***END OF THE PROJECT GUTENBERG",
    "End of the Project Gutenberg",
    "End of The Project Gutenberg",
    "Ende dieses Project Gutenberg",
    "by Project Gutenberg",
    "End of Project Gutenberg",
    "End of this Project Gutenberg",
    "Ende dieses Projekt Gutenberg",
    "        ***END OF THE PROJECT GUTENBERG",
    "*** END OF THE COPYRIGHTED",
    "End of this is COPYRIGHTED",
    "Ende dieses Etextes ",
    "Ende dieses Project Gutenber",
    "Ende diese Project Gutenberg",
    "**This is a COPYRIGHTED Project Gutenberg Etext, Details Above**",
    "Fin de Project Gutenberg",
    "The Project Gutenberg Etext of ",
    "Ce document fut presente en lecture",
    "Ce document fut pr",
    "More information about this book is at the top of this file.",
    "We need your donations more than ever!",
    "END OF PROJECT GUTENBERG",
    " End of the Project Gutenberg",
    " *** END OF THIS PROJECT GUTENBERG",
)


def any_of(prefixes: Iterable[str]) -> str:
    """Regular expression for one of some literal strings."""
    return "(?:" + "|".join("\\Q" + p.replace("\\E", "\\E\\\\E\\Q") + "\\E" for p in prefixes) + ")"


def starts_with_any(line: Column | str, prefixes: Iterable[str]) -> Column:
    """True iff one of the prefixes begins the line."""
    line = F.col(line) if isinstance(line, str) else line
    return line.rlike("^" + any_of(prefixes))


def body(
    text: Column | str,
    start: Iterable[str] = START_MARKERS,
    end: Iterable[str] = END_MARKERS,
    joiner: str = "",
) -> Column:
    """Lines after the first start-marker line and before the first end-marker line after it.

    Only line feeds end a line; the lines are joined by ``joiner``. Empty if no line starts
    with a start marker; without an end marker the body runs to the end of the text.
    """
    text = F.col(text) if isinstance(text, str) else text
    # d: only \n counts as a line end; m: ^ holds at every line; s: a dot takes \n too.
    after = F.regexp_extract(text, rf"(?md)^{any_of(start)}[^\n]*\n((?s:.*))", 1)
    cut = F.regexp_extract(after, rf"(?s)\A(.*?)(?:(?:\n|\A){any_of(end)}|\z)", 1)
    if joiner:
        # Empty lines at the very end of a text are not lines of it.
        cut = F.when(F.length(cut) < F.length(after), cut).otherwise(F.rtrim(cut, F.lit("\n")))
    return F.replace(cut, F.lit("\n"), F.lit(joiner))
