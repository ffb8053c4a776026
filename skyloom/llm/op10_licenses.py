"""Operator 10: licence scans with one Aho-Corasick automaton and a shunting-yard parser.

The automaton holds base phrases, notice phrases and identifier tags over the text's words. Words are runs of a-z, 0-9 and
non-ASCII characters after A-Z is lower-cased. Of notices that lie within a longer one, only the longer counts. Where the automaton finds an identifier
tag, the licence expression behind that place of the raw text is brought into postfix order by precedence (with, then and, then or) and
evaluated to its labels, its exceptions and to whether its terms can be met by permissive licences alone.

An operand is an identifier of the public SPDX list (any case, + allowed), a LicenseRef, or has the shape of one: a letter first, a hyphen and a digit. Identifiers
outside the list are their own label. The expression ends before an operator whose right side isn't an operand, for that's prose. One that doesn't begin with an
operand or leaves a bracket open adds nothing.

Null and empty texts give zero counts, null positions, empty labels and score 0. Repeated rows and null ids are kept.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

#: Base phrases and their labels (fixed values).
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Further notice phrases by label: names and opening words of the licences.
NOTICES = {
    "agpl": ["gnu affero general public license"],
    "gpl": ["gnu general public license", "gnu gpl"],
    "lgpl": ["gnu lesser general public license", "gnu library general public license", "gnu lgpl"],
    "gfdl": ["gnu free documentation license"],
    "mpl": ["mozilla public license"],
    "mit": ["the mit license", "mit licensed", "permission is hereby granted free of charge to any person obtaining a copy"],
    "bsd": ["redistribution and use in source and binary forms", "bsd 2 clause", "bsd 3 clause", "2 clause bsd", "3 clause bsd", "new bsd license", "simplified bsd license", "modified bsd license"],
    "apache": ["licensed under the apache license", "apache software license"],
    "isc": ["permission to use copy modify and or distribute this software", "the isc license"],
    "zlib": ["altered source versions must be plainly marked as such", "zlib license"],
    "bsl": ["boost software license"],
    "cc-by": ["creative commons attribution", "cc by"],
    "cc-by-sa": ["creative commons attribution sharealike", "creative commons attribution share alike", "cc by sa"],
    "cc-by-nd": ["creative commons attribution noderivatives", "creative commons attribution noderivs", "cc by nd"],
    "cc-by-nc": ["creative commons attribution noncommercial", "creative commons attribution non commercial"],
    "cc-by-nc-sa": ["creative commons attribution noncommercial sharealike", "creative commons attribution noncommercial share alike", "cc by nc sa"],
    "cc-by-nc-nd": ["creative commons attribution noncommercial noderivatives", "creative commons attribution noncommercial noderivs", "cc by nc nd"],
    "cc0": ["cc0 1 0 universal", "creative commons zero", "cc0 public domain dedication"],
    "unlicense": ["this is free and unencumbered software released into the public domain", "the unlicense"],
    "public-domain": ["dedicated to the public domain", "released into the public domain", "placed in the public domain"],
    "epl": ["eclipse public license"],
    "eupl": ["european union public licence"],
    "cddl": ["common development and distribution license"],
    "cpl": ["common public license"],
    "artistic": ["the artistic license", "artistic license 2 0"],
    "afl": ["academic free license"],
    "osl": ["open software license"],
    "ofl": ["sil open font license"],
    "odbl": ["open database license", "open data commons open database license"],
    "psf": ["python software foundation license"],
    "ms-pl": ["microsoft public license"],
    "ms-rl": ["microsoft reciprocal license"],
    "cecill": ["cecill free software license"],
    "wtfpl": ["do what the fuck you want to public license"],
    "busl": ["business source license"],
    "sspl": ["server side public license"],
    "proprietary": ["all rights reserved"],
}
_LONGEST = max(len(p) for ps in NOTICES.values() for p in ps) + 2
TAG = "spdx license identifier"
_GNU = "{,+,-only,-or-later}"
#: The public SPDX list by label (fixed values): identifiers, alternatives in braces. First those whose terms are permissive.
PERMISSIVE = {
    "mit": "MIT{,-0,-advertising,-CMU,-enna,-feh,-Festival,-Khronos-old,-Modern-Variant,-open-group,-testregex,-Wu} MITNFA X11{,-distribute-modifications-variant,-swapped} Xfig Xnet NCSA curl ICU UPL-1.0 HPND{,-DEC,-doc,-doc-sell,-export-US,-Fenneberg-Livingston,-Intel,-Kevlin-Henney,-Markus-Kuhn,-MIT-disclaimer,-Netrek,-Pbmplus,-sell-variant,-UC}",
    "apache-2": "Apache-2.0",
    "apache": "Apache-{1.0,1.1} ECL-{1.0,2.0} EFL-{1.0,2.0}",
    "bsd": "0BSD BSD-1-Clause BSD-2-Clause{,-Darwin,-first-lines,-FreeBSD,-NetBSD,-Patent,-pkgconf-disclaimer,-Views} BSD-3-Clause{,-acpica,-Attribution,-Clear,-flex,-HP,-LBNL,-Modification,-No-Military-License,-No-Nuclear-License,-No-Nuclear-License-2014,-No-Nuclear-Warranty,-Open-MPI,-Sun} BSD-4-Clause{,-Shortened,-UC} BSD-{4.3RENO,4.3TAHOE,Advertising-Acknowledgement,Attribution-HPND-disclaimer,Inferno-Nettverk,Protection,Source-beginning-file,Source-Code,Systemics,Systemics-W3Works}",
    "isc": "ISC{,-Veillard}",
    "zlib": "Zlib zlib-acknowledgement Libpng libpng-2.0",
    "bsl": "BSL-1.0",
    "cc0": "CC0-1.0",
    "cc-by": "CC-BY-{1.0,2.0,2.5,2.5-AU,3.0,3.0-AT,3.0-AU,3.0-DE,3.0-IGO,3.0-NL,3.0-US,4.0}",
    "unlicense": "Unlicense",
    "public-domain": "CC-PDDC CC-PDM-1.0 PDDL-1.0 SAX-PD{,-2.0} blessing libselinux-1.0 NIST-PD{,-fallback}",
    "wtfpl": "WTFPL",
    "psf": "PSF-2.0 Python-{2.0,2.0.1} CNRI-{Jython,Python,Python-GPL-Compatible}",
    "php": "PHP-{3.0,3.01}",
    "artistic": "Artistic-{1.0,1.0-cl8,1.0-Perl,2.0} ClArtistic",
    "afl": "AFL-{1.1,1.2,2.0,2.1,3.0}",
    "ms-pl": "MS-PL",
    "openssl": "OpenSSL OpenSSL-standalone SSLeay-standalone",
    "openldap": "OLDAP-{1.1,1.2,1.3,1.4,2.0,2.0.1,2.1,2.2,2.2.1,2.2.2,2.3,2.4,2.5,2.6,2.7,2.8}",
    "w3c": "W3C{,-19980720,-20150513}",
    "zpl": "ZPL-{1.1,2.0,2.1}",
    "ofl": "OFL-{1.0,1.1}{,-RFN,-no-RFN}",
    "odc-by": "ODC-By-1.0",
    "ogl": "OGL-UK-{1.0,2.0,3.0} OGL-Canada-2.0 OGC-1.0",
    "cern-ohl-p": "CERN-OHL-{1.1,1.2,P-2.0}",
    "other-permissive": "AAL ADSL Afmparse AMDPLPA AML ANTLR-PD{,-fallback} Bahyph Barr Beerware BitTorrent-{1.0,1.1} BlueOak-1.0.0 Borceux Caldera Cube Crossword CrystalStacker DOC Dotseqn DSDP dvipdfm EUDatagrid Entessa Fair FSFAP FSFUL FSFULLR FTL Giftware Glulxe GL2PS HaskellReport IJG{,-short} ImageMagick Info-ZIP Intel JasPer-2.0 JSON Latex2e Leptonica libtiff Linux-OpenIB MakeIndex Minpack MirOS MTLL Mup mpich2 Multics NAIST-2003 Naumen NBPL-1.0 Net-SNMP NetCDF Newsletr NLOD-{1.0,2.0} NLPL NTP{,-0} OGTSL OML Plexus PostgreSQL psfrag psutils Qhull Rdisc RSA-MD Ruby Saxpath SGI-B-{1.0,1.1,2.0} SMLNJ Spencer-{86,94,99} StandardML-NJ SunPro SWL TCL TCP-wrappers TMate TU-Berlin-{1.0,2.0} Unicode-{3.0,DFS-2015,DFS-2016,TOU} UCAR VSL-1.0 Wsuipa Xerox XSkat xinetd xpp Zed Zend-2.0 Zimbra-{1.3,1.4}",
}
OTHER = {
    "gpl": f"GPL-{{1.0,2.0,3.0}}{_GNU} GPL-2.0-with-{{autoconf,bison,classpath,font,GCC}}-exception GPL-3.0-with-{{autoconf,GCC}}-exception",
    "lgpl": f"LGPL-{{2.0,2.1,3.0}}{_GNU} LGPLLR",
    "agpl": f"AGPL-{{1.0,3.0}}{_GNU}",
    "gfdl": "GFDL-{1.1,1.2,1.3}{,-only,-or-later,-invariants-only,-invariants-or-later,-no-invariants-only,-no-invariants-or-later}",
    "mpl": "MPL-{1.0,1.1,2.0,2.0-no-copyleft-exception}",
    "epl": "EPL-{1.0,2.0}",
    "eupl": "EUPL-{1.0,1.1,1.2}",
    "cddl": "CDDL-{1.0,1.1}",
    "cpl": "CPL-1.0 IPL-1.0",
    "cpal": "CPAL-1.0",
    "osl": "OSL-{1.0,1.1,2.0,2.1,3.0} NPOSL-3.0",
    "npl": "NPL-{1.0,1.1} NOSL",
    "lppl": "LPPL-{1.0,1.1,1.2,1.3a,1.3c}",
    "cecill": "CECILL-{1.0,1.1,2.0,2.1,B,C}",
    "odbl": "ODbL-1.0",
    "cc-by-sa": "CC-BY-SA-{1.0,2.0,2.0-UK,2.1-JP,2.5,3.0,3.0-AT,3.0-DE,3.0-IGO,4.0}",
    "cc-by-nd": "CC-BY-ND-{1.0,2.0,2.5,3.0,3.0-DE,4.0}",
    "cc-by-nc": "CC-BY-NC-{1.0,2.0,2.5,3.0,3.0-DE,4.0}",
    "cc-by-nc-sa": "CC-BY-NC-SA-{1.0,2.0,2.0-DE,2.0-FR,2.0-UK,2.5,3.0,3.0-DE,3.0-IGO,4.0}",
    "cc-by-nc-nd": "CC-BY-NC-ND-{1.0,2.0,2.5,3.0,3.0-DE,3.0-IGO,4.0}",
    "ms-rl": "MS-RL MS-LPL",
    "cern-ohl": "CERN-OHL-{S,W}-2.0",
    "busl": "BUSL-1.1",
    "sspl": "SSPL-1.0",
    "other-reciprocal": "Adobe-{2006,Glyph,Utopia} Aladdin APAFML APL-1.0 APSL-{1.0,1.1,1.2,2.0} CAL-1.0{,-Combined-Work-Exception} Condor-1.1 copyleft-next-{0.3.0,0.3.1} CUA-OPL-1.0 D-FSL-1.0 diffmark ErlPL-1.1 Elastic-2.0 Frameworx-1.0 gSOAP-1.3b Hippocratic-2.1 IPA Interbase-1.0 LAL-{1.2,1.3} LiLiQ-{P,R,Rplus}-1.1 LPL-{1.0,1.02} Motosoto MulanPSL-{1.0,2.0} NASA-1.3 NGPL Nokia Noweb OCLC-2.0 OPL-1.0 OPUBL-1.0 OSET-PL-2.1 Parity-{6.0.0,7.0.0} PolyForm-{Noncommercial,Small-Business}-1.0.0 QPL-1.0 RPL-{1.1,1.5} RPSL-1.0 RSCPL SCEA SimPL-2.0 SISSL{,-1.2} Sleepycat SPL-1.0 SugarCRM-1.1.3 TAPR-OHL-1.0 TORQUE-1.1 Vim Watcom-1.0 wxWindows YPL-{1.0,1.1}",
}
#: Exceptions whose names don't say so (fixed values); all others hold the word.
EXCEPTIONS = {"linux-syscall-note", "gpl-cc-1.0", "shl-2.0", "shl-2.1", "ocaml-lgpl-linking-exception", "llvm-exception"}
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
#: ASCII that ends a word becomes a space; A-Z becomes a-z.
_TO_WORDS = bytes.maketrans(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]), b" " * (0x30 + 0x27 + 0x05))
_WORD = re.compile(rb"[^ ]+")
_BEFORE, _TOKEN = re.compile(r"[ \t\n\x0b\x0c\r:=]*"), re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.\-]*\+?)")
_ID_SHAPE = re.compile(r"(?=[^0-9]*[0-9])[a-z][a-z0-9.]*-[a-z0-9.+\-]+|(documentref-[a-z0-9.\-]+:)?licenseref-[a-z0-9.\-]+")


def spelled(pattern: str) -> list[str]:
    """All strings of a pattern with alternatives in braces."""
    parts = [p[1:-1].split(",") if p.startswith("{") else [p] for p in re.findall(r"\{[^}]*\}|[^{}]+", pattern)]
    return ["".join(x) for x in product(*parts)]


@lru_cache(maxsize=1)
def identifiers() -> dict[str, tuple[str, bool]]:
    """Label and permissiveness of each identifier, in small letters."""
    return {i.lower(): (label, free) for free, lists in ((True, PERMISSIVE), (False, OTHER)) for label, said in lists.items() for p in said.split() for i in spelled(p)}


def _operand(token: str) -> str | None:
    """The identifier in small letters; None for what isn't one. The + of an unlisted form goes with its licence."""
    low = token.lower().rstrip(".-")
    known = identifiers()
    if low in known:
        return low
    if low.endswith("+") and low[:-1] in known:
        return low[:-1]
    return low if _ID_SHAPE.fullmatch(low) else None


def _is_exception(token: str) -> bool:
    low = token.lower()
    return low in EXCEPTIONS or "exception" in low


def postfix(text: str, at: int = 0) -> list[str]:
    """Shunting yard from ``at`` as far as the expression goes; raises ValueError where none is."""
    out: list[str] = []
    waiting: list[str] = []
    operand_next, depth = True, 0

    def token(at: int) -> tuple[str, int]:
        m = _TOKEN.match(text, at)
        return (m[1], m.end()) if m else ("", at)

    while True:
        said, after = token(at)
        low = said.lower()
        if operand_next:
            if low == "(":
                waiting.append(low)
                depth += 1
            elif known := _operand(said):
                out.append(known)
                operand_next = False
            else:
                raise ValueError(f"operand expected, not {said!r}")
        elif low == "with":
            exception, after = token(after)
            if not _is_exception(exception):
                break
            out += [exception.lower(), "with"]  # it binds closest, and takes a licence and an exception
        elif low in PRECEDENCE:
            right, _ = token(after)
            if right != "(" and not _operand(right):
                break
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[low]:
                out.append(waiting.pop())
            waiting.append(low)
            operand_next = True
        elif low == ")" and depth:
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
            depth -= 1
        else:
            break  # prose follows
        at = after
    if depth:
        raise ValueError("open bracket")
    return out + waiting[::-1]


def evaluate(text: str, at: int = 0) -> tuple[set[str], bool, set[str]]:
    """Labels of the expression that starts at ``at``, whether permissive licences can meet it, and its exceptions."""
    stack: list = []
    for token in postfix(text, at):
        if token == "with":
            exception, (labels, free, exceptions) = stack.pop(), stack.pop()
            stack.append((labels, free, exceptions | {exception}))
        elif token in PRECEDENCE:
            b, a = stack.pop(), stack.pop()
            stack.append((a[0] | b[0], (a[1] or b[1]) if token == "or" else (a[1] and b[1]), a[2] | b[2]))
        elif _is_exception(token) and token not in identifiers():
            stack.append(token)
        else:
            label, free = identifiers().get(token, (token, False))
            stack.append(({label}, free, set()))
    return stack[0]


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    made = ahocorasick.Automaton()
    found: dict[str, list] = {TAG: [("tag", "")]}
    for phrase, label in [*((p, ("base", w)) for p, w in BASE.items()), *((p, ("notice", w)) for w, ps in NOTICES.items() for p in ps)]:
        found.setdefault(phrase, []).append(label)
    for phrase, values in found.items():
        made.add_word(f" {phrase} ", (len(phrase) + 1, values))
    made.make_automaton()
    return made


def _around(notices: list, k: int, end: int):
    """Numbers of the notices that end where the k-th does, or after it by less than the longest phrase."""
    j = k
    while j and notices[j - 1][1] == end:
        j -= 1
    while j < len(notices) and notices[j][1] <= end + _LONGEST:
        yield j
        j += 1


def scan(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, permissive, exceptions of one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    apart = raw.lower().translate(_TO_WORDS)
    words = [w for w in apart.split(b" ") if w]
    joined = b" " + b" ".join(words) + b" "
    said, spaces = joined.decode("latin-1"), None

    def number(places: list[int]) -> list[int]:
        """Words that begin before each place of ``said``: one pass over its spaces, whatever the number of places."""
        nonlocal spaces
        spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == ord(" ")) if spaces is None else spaces
        return np.searchsorted(spaces, places).tolist()

    base, labels, exceptions, places, notices, tags, score, permissive = set(), set(), set(), [], [], [], 0.0, None
    for end, (width, values) in _automaton().iter(said):
        for kind, label in values:
            if kind == "base":
                places.append(end - width)
                base.add(label)
                score = max(score, 0.9)
            elif kind == "notice":
                notices.append((end - width, end, label))
            else:
                tags.append(end)
    for k, (a, e, label) in enumerate(notices):
        # they are in order of ends, so one that holds this ends with it or soon after
        near = [notices[j] for j in _around(notices, k, e)]
        if not any(b <= a and e <= f and (b, f) != (a, e) for b, f, _ in near):
            labels.add(label)
            score = max(score, 0.7)
    if tags:
        wanted, shown = {n - 1 for n in number(tags)}, raw.decode("latin-1")  # one character a byte: places in bytes hold, and expressions are ASCII
        for k, m in enumerate(_WORD.finditer(apart)):
            if k in wanted:  # a tag's last word
                try:
                    found, free, without = evaluate(shown, _BEFORE.match(shown, m.end()).end())
                except ValueError:
                    continue
                labels |= found
                exceptions |= without
                score, permissive = 1.0, free if permissive is None else permissive and free
    first, last = number([min(places), max(places)]) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), score, permissive, ",".join(sorted(exceptions))


_COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "permissive", "exceptions"]


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the columns of :func:`scan` for every document."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, permissive boolean, exceptions string")
    def scan_all(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([scan(t) for t in texts], columns=_COLUMNS)
        return out.astype({"first_word": "Int64", "last_word": "Int64", "permissive": "boolean"})

    return docs.select(F.col(id_col).alias("doc_id"), scan_all.asNondeterministic()(F.col(text_col)).alias("r")).select("doc_id", "r.*")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(table(spark, sf_dir, "documents"))


#: Base columns could be told in SQL, the method's own labels not; tests compare with a brute-force version.
