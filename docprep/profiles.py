"""Rule profiles: how a family of documents marks titles, section headers, exceptions and the end of its text."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from docprep.functions.text import strip


@dataclass(frozen=True)
class Header:
    """A row is a header if all that is given holds. `stops`: it ends the text if it reads like the profile's stop text."""

    path_has: str | None = None
    path_lacks: str | None = None
    path_not: tuple[str, ...] = ()
    text_matches: str | None = None
    text_starts: str | None = None
    text_has: tuple[str, ...] = ()
    text_is: tuple[str, ...] = ()
    text_not: tuple[str, ...] = ()
    stops: bool = True

    def holds(self, path: Column, text: Column, stripped: Column) -> Column:
        tests = [F.lit(True)]
        if self.path_has:
            tests.append(path.contains(self.path_has))
        if self.path_lacks:
            tests.append(~path.contains(self.path_lacks))
        if self.path_not:
            tests.append(~path.isin(*self.path_not))
        if self.text_matches:
            tests.append(text.rlike(self.text_matches))
        if self.text_starts:
            tests.append(text.startswith(self.text_starts))
        tests += [text.contains(t) for t in self.text_has]
        if self.text_is:
            tests.append(stripped.isin(*self.text_is))
        if self.text_not:
            tests.append(~stripped.isin(*self.text_not))
        return reduce(lambda a, b: a & b, tests)


@dataclass(frozen=True)
class Profile:
    """title_is / title_has: the title's path, equal or contained. title_only: a title row is nothing else besides.

    stop: the text that ends the document, on any row if stop_anywhere, else on headers that may stop. keep: texts that
    become sections and exceptions. body: headers of these rules are body text after all.
    """

    name: str
    headers: tuple[Header, ...]
    title_is: str | None = None
    title_has: str | None = None
    title_only: bool = True
    stop: str | None = None
    stop_anywhere: bool = False
    keep: tuple[str, ...] = ()
    extra_stops: tuple[Header, ...] = field(default=())
    body: tuple[Header, ...] = field(default=())

    def is_title(self, path: Column) -> Column:
        return path == self.title_is if self.title_is else path.contains(self.title_has) if self.title_has else F.lit(False)

    def row_class(self, path: Column, text: Column, stripped: Column) -> Column:
        """TITLE, STOP, KEEP, HEADER or TEXT of a row with a text; the first that holds counts. `stripped` is the text without white space around."""
        stops = (stripped == self.stop) if self.stop else F.lit(False)
        cases: list[tuple[Column, str | Column]] = []
        if self.title_only:
            cases.append((self.is_title(path), "TITLE"))
        if self.stop_anywhere:
            cases.append((stops, "STOP"))
        if self.keep:
            cases.append((stripped.isin(*self.keep), "KEEP"))
        cases += [(h.holds(path, text, stripped) & stops, "STOP") for h in self.extra_stops]
        cases += [(h.holds(path, text, stripped), "TEXT") for h in self.body]
        for h in self.headers:
            if h.stops:
                cases.append((h.holds(path, text, stripped) & stops, "STOP"))
            cases.append((h.holds(path, text, stripped), "HEADER"))
        written = F.lit("TEXT")
        for condition, name in reversed(cases):
            written = F.when(condition, F.lit(name)).otherwise(written)
        return written


def media_class(path: Column) -> Column:
    """TABLE or FIGURE for the path of one at the top of the document, else null."""
    return F.when(path.rlike(r"^//Document/Table(?:\[\d+\])?$"), "TABLE").when(~path.contains("/Table") & path.rlike(r"^//Document/Figure(?:\[\d+\])?$"), "FIGURE")


#: Paths and texts of the four families of documents.
ACE = Profile(
    "ace",
    title_is="//Document/Title/Sub[2]",
    stop="References",
    keep=(
        "Recommendation  1 Assess the patient’s glycaemic control and risk of adverse cardiorenal outcomes.",
        "Lifestyle intervention: a cornerstone of successful T2DM management",
        "Insulin and T2DM",
        "Patient involvement and education",
        "Patient-centred care and shared decision-making",
        "Recommendation 5: Adopt a patient-centred approach to make shared decisions on T2DM management.",
        "Recommendation  6",
        "Recognising poor adherence to diabetes medications in practice",
        "Monitoring and follow-up",
    ),
    headers=(
        Header(
            path_has="/H1",
            path_not=("//Document/H1[9]/Figure",),
            text_not=("Objective", "Glycaemic control", "Risk of adverse cardiorenal outcomes", "Review parameters and frequency", "Interdisciplinary care"),
        ),
    ),
)
ACG = Profile("acg", title_is="//Document/Figure", stop="References", headers=(Header(path_has="/H1", text_not=("www.ace-hta.gov.sg",)),))
HEALTIERSG = Profile(
    "healtiersg",
    title_has="/Title",
    title_only=False,
    stop="(<>)References",
    keep=("Recent key changes:",),
    headers=(
        Header(path_has="/H", text_has=("<", ">")),
        Header(text_starts="(<>)"),
        Header(text_is=("Background \uf078", "Clinical Approach \uf078"), stops=False),
    ),
)
NUMBERING = Profile(
    "numbering",
    title_is="//Document/P[2]",
    stop="References",
    stop_anywhere=True,
    keep=(
        "Scope of the guidelines",
        "Algorithm for the management of breastfeeding",
        "Summary of recommendations",
        "Levels of Evidence and Grades of Recommendation",
        "Key references",
        "Acknowledgements",
        "STATEMENT OF INTENT",
        "FOREWORD",
        "CONTENTS",
    ),
    headers=(
        Header(path_has="/H", path_not=("//Document/H1[8]", "//Document/H1[9]", "//Document/H1[10]", "//Document/Aside[4]/H1"), text_matches=r"(?U)^\d+"),
        Header(path_lacks="Span", text_matches=r"(?U)^\d+\.\d+(\.\d+)?(\.\d+)?", stops=False),
    ),
)
#: For documents without a known profile: any heading is a header.
GENERIC = Profile("generic", title_has="/Title", stop="References", headers=(Header(path_has="/H"),))
PROFILES = {p.name: p for p in (ACE, ACG, HEALTIERSG, NUMBERING)}


def profile_name(raw: Column) -> Column:
    """The known profile that an unevenly spelled name means, else 'generic'."""
    name = F.lower(strip(raw))
    return F.when(name.isin(*PROFILES), name).otherwise(F.lit(GENERIC.name))
