"""Hand-written licence signatures, expanded from a family table.

A family row gives the label, the name as a regex over lower-case text, the
literals of which one must occur for the name to match (the gates, split by "|"),
an SPDX id regex and the gates and regex of a home URL. Every row yields ordered
rules of several kinds; together with the clause rules they make some three hundred.

Regexes and gates meet a text with every run of white space, and comment marks at the
beginning of a line, as one space, so wrapped headers match. Every alternative of a regex
must contain one of its gates (a test generates wordings from all rules). A group named
``at`` is the place of a detection; without one it is the whole match.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int  # higher wins over what it contains
    gates: tuple[str, ...]  # literals of which one must occur in the lower-case text, white space as one space
    pattern: re.Pattern[str]


_V = r",?\s+(?:version\s+|v\.?\s*)?"
_GPL = r"(?<!lesser )(?<!library )(?<!affero )(?:gnu\s+)?general\s+public\s+licen[sc]e"
_SHORT = r"[\s-]?(?:version\s+|v\.?\s*)"  # GPLv2, LGPL version 2.1
#: label, name, gates, SPDX id, URL gates, URL
_FAMILIES = [
    ("agpl-3.0", rf"(?:gnu\s+)?affero\s+general\s+public\s+licen[sc]e{_V}3(?:\.0)?|(?:gnu\s+)?agpl{_SHORT}3(?:\.0)?", "affero|agpl", r"agpl-3\.0(?:-only|-or-later)?", "gnu.org/licenses/agpl", r"gnu\.org/licenses/agpl"),
    ("agpl", r"(?:gnu\s+)?affero\s+general\s+public\s+licen[sc]e", "affero", r"agpl(?:-1\.0)?", "affero.org", r"affero\.org/oagpl"),
    ("lgpl-2.1", rf"(?:gnu\s+)?lesser\s+general\s+public\s+licen[sc]e{_V}2\.1|(?:gnu\s+)?lgpl{_SHORT}2\.1", "lesser general|lgpl", r"lgpl-2\.1(?:-only|-or-later)?", "lgpl-2.1", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("lgpl-3.0", rf"(?:gnu\s+)?lesser\s+general\s+public\s+licen[sc]e{_V}3(?:\.0)?|(?:gnu\s+)?lgpl{_SHORT}3(?:\.0)?", "lesser general|lgpl", r"lgpl-3\.0(?:-only|-or-later)?", "lgpl-3.0", r"gnu\.org/licenses/lgpl-3\.0"),
    ("lgpl-2.0", rf"(?:gnu\s+)?(?:lesser|library)\s+general\s+public\s+licen[sc]e{_V}2(?:\.0)?(?!\.\d)|(?:gnu\s+)?lgpl{_SHORT}2(?:\.0)?(?!\.\d)", "general public|lgpl", r"lgpl-2\.0(?:-only|-or-later)?", "lgpl-2.0", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.0"),
    ("lgpl", r"(?:gnu\s+)?(?:lesser|library)\s+general\s+public\s+licen[sc]e", "general public", r"lgpl", "lgpl.html", r"gnu\.org/licenses/lgpl\.html"),
    ("gpl-2.0", rf"{_GPL}{_V}2(?:\.0)?(?!\.\d)|(?:gnu\s+)?gpl{_SHORT}2(?:\.0)?(?!\.\d)", "general public|gpl", r"gpl-2\.0(?:-only|-or-later)?", "gpl-2.0", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-3.0", rf"{_GPL}{_V}3(?:\.0)?|(?:gnu\s+)?gpl{_SHORT}3(?:\.0)?", "general public|gpl", r"gpl-3\.0(?:-only|-or-later)?", "gpl-3.0", r"gnu\.org/licenses/gpl-3\.0"),
    ("gfdl", r"gnu\s+free\s+documentation\s+licen[sc]e", "free documentation", r"gfdl-1\.[123](?:-only|-or-later)?", "fdl", r"gnu\.org/(?:copyleft|licenses)/fdl"),
    ("apache-2.0", rf"apache\s+(?:software\s+)?licen[sc]e{_V}2(?:\.0)?", "apache", r"apache-2\.0", "apache.org/licenses/license-2.0", r"apache\.org/licenses/license-2\.0"),
    ("apache-1.1", rf"apache\s+(?:software\s+)?licen[sc]e{_V}1\.1", "apache", r"apache-1\.1", "apache.org/licenses/license-1.1", r"apache\.org/licenses/license-1\.1"),
    ("mit-0", r"mit\s+no\s+attribution(?:\s+licen[sc]e)?", "no attribution", r"mit-0", "aws/mit-0", r"github\.com/aws/mit-0"),
    ("mit-x11", r"(?:mit[\s/-]+x11|x11)\s+licen[sc]e", "x11", r"x11", "x.org/licen", r"x\.org/licen"),
    ("bsd-2-clause", r"(?:2|two)[\s-]clause\s+bsd(?:\s+licen[sc]e)?|simplified\s+bsd(?:\s+licen[sc]e)?|bsd\s+2[\s-]clause", "bsd", r"bsd-2-clause", "bsd-2-clause", r"opensource\.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", r"(?:3|three)[\s-]clause\s+bsd(?:\s+licen[sc]e)?|(?:new|revised|modified)\s+bsd(?:\s+licen[sc]e)?|bsd\s+3[\s-]clause", "bsd", r"bsd-3-clause", "bsd-3-clause", r"opensource\.org/licenses/bsd-3-clause"),
    ("bsd-4-clause", r"(?:4|four)[\s-]clause\s+bsd(?:\s+licen[sc]e)?|original\s+bsd(?:\s+licen[sc]e)?", "bsd", r"bsd-4-clause", "bsd-4-clause", r"spdx\.org/licenses/bsd-4-clause"),
    ("bsd", r"bsd(?:[\s-]style)?\s+licen[sc]e", "bsd", r"bsd", "bsd-license", r"opensource\.org/licenses/bsd-license"),
    ("0bsd", r"zero[\s-]clause\s+bsd(?:\s+licen[sc]e)?", "clause bsd", r"0bsd", "licenses/0bsd", r"opensource\.org/licenses/0bsd"),
    ("cc-by-4.0", rf"(?:creative\s+commons\s+attribution|cc[\s-]by){_V}4(?:\.0)?", "creative commons|cc by|cc-by", r"cc-by-4\.0", "licenses/by/4.0", r"creativecommons\.org/licenses/by/4\.0"),
    ("cc-by-3.0", rf"(?:creative\s+commons\s+attribution|cc[\s-]by){_V}3(?:\.0)?", "creative commons|cc by|cc-by", r"cc-by-3\.0", "licenses/by/3.0", r"creativecommons\.org/licenses/by/3\.0"),
    ("cc-by-sa", r"creative\s+commons\s+attribution[\s-]+share\s?alike|cc[\s-]by[\s-]sa", "creative commons|cc by|cc-by", r"cc-by-sa-[1-4]\.\d", "licenses/by-sa", r"creativecommons\.org/licenses/by-sa"),
    ("cc-by-nc", r"creative\s+commons\s+attribution[\s-]+non[\s-]?commercial|cc[\s-]by[\s-]nc", "creative commons|cc by|cc-by", r"cc-by-nc-[1-4]\.\d", "licenses/by-nc/", r"creativecommons\.org/licenses/by-nc/"),
    ("cc-by-nd", r"creative\s+commons\s+attribution[\s-]+no[\s-]?deriv(?:ative)?s?|cc[\s-]by[\s-]nd", "creative commons|cc by|cc-by", r"cc-by-nd-[1-4]\.\d", "licenses/by-nd/", r"creativecommons\.org/licenses/by-nd/"),
    ("cc-by-nc-sa", r"cc[\s-]by[\s-]nc[\s-]sa|attribution[\s-]+non[\s-]?commercial[\s-]+share\s?alike", "attribution|cc by|cc-by", r"cc-by-nc-sa-[1-4]\.\d", "licenses/by-nc-sa", r"creativecommons\.org/licenses/by-nc-sa"),
    ("cc-by-nc-nd", r"cc[\s-]by[\s-]nc[\s-]nd|attribution[\s-]+non[\s-]?commercial[\s-]+no[\s-]?deriv(?:ative)?s?", "attribution|cc by|cc-by", r"cc-by-nc-nd-[1-4]\.\d", "licenses/by-nc-nd", r"creativecommons\.org/licenses/by-nc-nd"),
    ("cc0", r"cc0(?:\s+1\.0)?|creative\s+commons\s+zero", "creative commons|cc0", r"cc0-1\.0", "publicdomain/zero", r"creativecommons\.org/publicdomain/zero"),
    ("mpl-1.1", rf"mozilla\s+public\s+licen[sc]e{_V}1\.1", "mozilla", r"mpl-1\.1", "mpl/1.1", r"mozilla\.org/mpl/1\.1"),
    ("mpl-2.0", rf"mozilla\s+public\s+licen[sc]e{_V}2(?:\.0)?", "mozilla", r"mpl-2\.0", "mpl/2.0", r"mozilla\.org/mpl/2\.0"),
    ("mpl", r"mozilla\s+public\s+licen[sc]e", "mozilla", r"mpl", "mozilla.org/mpl", r"mozilla\.org/mpl"),
    ("epl-1.0", rf"eclipse\s+public\s+licen[sc]e{_V}1(?:\.0)?", "eclipse", r"epl-1\.0", "epl-v10", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", rf"eclipse\s+public\s+licen[sc]e{_V}2(?:\.0)?", "eclipse", r"epl-2\.0", "epl-2.0", r"eclipse\.org/legal/epl-2\.0"),
    ("edl-1.0", r"eclipse\s+distribution\s+licen[sc]e", "eclipse", r"edl-1\.0", "edl-v10", r"eclipse\.org/org/documents/edl-v10"),
    ("cddl-1.0", r"common\s+development\s+and\s+distribution\s+licen[sc]e", "common development", r"cddl-1\.[01]", "cddl", r"opensource\.org/licenses/cddl"),
    ("cpl-1.0", r"common\s+public\s+licen[sc]e", "common public", r"cpl-1\.0", "licenses/cpl", r"opensource\.org/licenses/cpl"),
    ("isc", r"isc\s+licen[sc]e", "isc", r"isc", "licenses/isc", r"opensource\.org/licenses/isc"),
    ("zlib", r"zlib(?:/libpng)?\s+licen[sc]e", "zlib", r"zlib", "zlib_license", r"zlib\.net/zlib_license"),
    ("libpng", r"libpng\s+licen[sc]e", "libpng", r"libpng(?:-2\.0)?", "src/libpng-license", r"libpng\.org/pub/png/src/libpng-license"),
    ("unlicense", r"the\s+unlicen[sc]e", "unlicen", r"unlicense", "unlicense.org", r"unlicense\.org"),
    ("wtfpl", r"do\s+what\s+the\s+f\S*\s+you\s+want\s+to\s+public\s+licen[sc]e", "do what the", r"wtfpl", "wtfpl.net", r"wtfpl\.net"),
    ("artistic-1.0", rf"artistic\s+licen[sc]e{_V}1(?:\.0)?", "artistic", r"artistic-1\.0(?:-perl)?", "artistic-license-1.0", r"opensource\.org/licenses/artistic-license-1\.0"),
    ("artistic-2.0", rf"artistic\s+licen[sc]e{_V}2(?:\.0)?", "artistic", r"artistic-2\.0", "artistic_license_2_0", r"perlfoundation\.org/artistic_license_2_0"),
    ("artistic", r"artistic\s+licen[sc]e", "artistic", r"artistic", "artistic.html", r"perl\.com/.{0,40}artistic\.html"),
    ("bsl-1.0", r"boost\s+software\s+licen[sc]e", "boost", r"bsl-1\.0", "license_1_0.txt", r"boost\.org/license_1_0\.txt"),
    ("busl-1.1", r"business\s+source\s+licen[sc]e", "business source", r"busl-1\.1", "bsl11", r"mariadb\.com/bsl11"),
    ("sspl-1.0", r"server\s+side\s+public\s+licen[sc]e", "server side", r"sspl-1\.0", "server-side-public-license", r"mongodb\.com/licensing/server-side-public-license"),
    ("elastic-2.0", r"elastic\s+licen[sc]e", "elastic", r"elastic-2\.0", "elastic-license", r"elastic\.co/licensing/elastic-license"),
    ("eupl-1.1", rf"european\s+union\s+public\s+licen[sc]e{_V}1\.1", "european union", r"eupl-1\.1", "eupl1.1", r"ec\.europa\.eu/.{0,40}eupl1\.1"),
    ("eupl-1.2", rf"european\s+union\s+public\s+licen[sc]e{_V}1\.2", "european union", r"eupl-1\.2", "eupl-1.2", r"joinup\.ec\.europa\.eu/.{0,60}eupl-1\.2"),
    ("cecill", r"cecill(?:-[bc])?\s+licen[sc]e|licen[sc]e\s+cecill", "cecill", r"cecill-(?:1\.[01]|2\.[01]|b|c)", "cecill.info", r"cecill\.info/licen"),
    ("ofl-1.1", r"(?:sil\s+)?open\s+font\s+licen[sc]e", "open font", r"ofl-1\.[01]", "scripts.sil.org/ofl", r"scripts\.sil\.org/ofl"),
    ("odbl", r"open\s+database\s+licen[sc]e", "open database", r"odbl-1\.0", "licenses/odbl", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by", r"open\s+data\s+commons\s+attribution\s+licen[sc]e", "open data commons", r"odc-by-1\.0", "opendatacommons.org/licenses/by", r"opendatacommons\.org/licenses/by"),
    ("pddl", r"public\s+domain\s+dedication\s+and\s+licen[sc]e", "public domain ded", r"pddl-1\.0", "licenses/pddl", r"opendatacommons\.org/licenses/pddl"),
    ("psf-2.0", r"python\s+software\s+foundation\s+licen[sc]e", "python software", r"psf-2\.0", "python.org/psf/license", r"python\.org/psf/license"),
    ("php-3.01", r"php\s+licen[sc]e", "php", r"php-3\.0[1]?", "php.net/license", r"php\.net/license"),
    ("ruby", r"ruby\s+licen[sc]e", "ruby", r"ruby", "ruby-lang.org/en/about/license", r"ruby-lang\.org/en/about/license"),
    ("ms-pl", r"microsoft\s+public\s+licen[sc]e", "microsoft", r"ms-pl", "licenses/ms-pl", r"opensource\.org/licenses/ms-pl"),
    ("ms-rl", r"microsoft\s+reciprocal\s+licen[sc]e", "microsoft", r"ms-rl", "licenses/ms-rl", r"opensource\.org/licenses/ms-rl"),
    ("ncsa", r"university\s+of\s+illinois.{0,20}open\s+source\s+licen[sc]e", "illinois", r"ncsa", "licenses/ncsa", r"opensource\.org/licenses/ncsa"),
    ("ecl-2.0", r"educational\s+community\s+licen[sc]e", "educational", r"ecl-[12]\.0", "licenses/ecl", r"opensource\.org/licenses/ecl"),
    ("osl-3.0", r"open\s+software\s+licen[sc]e", "open software", r"osl-[123]\.[01]", "licenses/osl", r"opensource\.org/licenses/osl"),
    ("afl-3.0", r"academic\s+free\s+licen[sc]e", "academic free", r"afl-[123]\.[012]", "licenses/afl", r"opensource\.org/licenses/afl"),
    ("openssl", r"openssl\s+licen[sc]e", "openssl", r"openssl", "openssl.org/source/license", r"openssl\.org/source/license"),
    ("postgresql", r"postgresql\s+licen[sc]e", "postgresql", r"postgresql", "postgresql.org/about/licen", r"postgresql\.org/about/licen"),
    ("upl-1.0", r"universal\s+permissive\s+licen[sc]e", "universal permissive", r"upl-1\.0", "licenses/upl", r"opensource\.org/licenses/upl"),
    ("vim", r"vim\s+licen[sc]e", "vim", r"vim", "vimdoc.sourceforge", r"vimdoc\.sourceforge\.net/.{0,40}license"),
    ("curl", r"curl\s+licen[sc]e", "curl", r"curl", "curl.se/docs/copyright", r"curl\.se/docs/copyright"),
    ("openrail", r"(?:creativeml\s+)?open\s?rail(?:-[ms]|\+\+-m)?\s+licen[sc]e", "rail", r"(?:creativeml-)?openrail(?:-m)?", "huggingface.co/spaces", r"huggingface\.co/spaces/.{0,60}license"),
    ("gpl", rf"{_GPL}|gnu\s+gpl", "general public|gnu gpl", r"gpl", "gnu.org/licenses", r"gnu\.org/licenses/(?:gpl\.html|\s|$)"),
    ("apache", r"apache\s+(?:software\s+)?licen[sc]e|apache\s+licensed", "apache", r"apache", "apache.org/licenses", r"apache\.org/licenses/?(?:\s|$)"),
    ("cc-by", r"creative\s+commons\s+attribution|cc[\s-]by", "creative commons|cc by|cc-by", r"cc-by", "licenses/by", r"creativecommons\.org/licenses/by(?:\s|$|/(?![34]\.0))"),
    ("mit", r"mit\s+licen[sc]e|mit\s+licensed", "mit", r"mit", "licenses/mit", r"opensource\.org/licenses/mit"),
]
#: label, priority, gates, regex: clauses that stand for a licence without its name
_CLAUSES = [
    ("mit", 75, "permission is hereby granted, free of charge", r"permission\s+is\s+hereby\s+granted,\s+free\s+of\s+charge,\s+to\s+any\s+person\s+obtaining\s+a\s+copy"),
    ("isc", 75, "permission to use, copy, modify", r"permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software\s+for\s+any\s+purpose"),
    ("bsd", 75, "redistribution and use in source", r"redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms,\s+with\s+or\s+without\s+modification"),
    ("bsd-3-clause", 76, "neither the name", r"neither\s+the\s+names?\s+of\s+.{1,120}?\s+may\s+be\s+used\s+to\s+endorse\s+or\s+promote"),
    ("bsd-4-clause", 77, "all advertising materials", r"all\s+advertising\s+materials\s+mentioning\s+features\s+or\s+use\s+of\s+this\s+software"),
    ("gpl", 75, "free software; you can redistribute", r"free\s+software;\s+you\s+can\s+redistribute\s+it\s+and/or\s+modify\s+it\s+under\s+the\s+terms"),
    ("unlicense", 75, "unencumbered software", r"free\s+and\s+unencumbered\s+software\s+released\s+into\s+the\s+public\s+domain"),
    ("zlib", 75, "provided 'as-is'", r"provided\s+'as-is',\s+without\s+any\s+express\s+or\s+implied\s+warranty"),
    ("apache-2.0", 75, "you may not use this file except", r"you\s+may\s+not\s+use\s+this\s+file\s+except\s+in\s+compliance\s+with\s+the\s+license"),
    ("mpl-2.0", 75, "this source code form is subject", r"this\s+source\s+code\s+form\s+is\s+subject\s+to\s+the\s+terms\s+of\s+the\s+mozilla"),
    ("bsl-1.0", 75, "machine-executable object code", r"machine-executable\s+object\s+code\s+generated\s+by\s+a\s+source\s+language\s+processor"),
    ("public-domain", 40, "public domain", r"(?:released|dedicated|placed|put|is)\s+(?:(?:in|into|to)\s+)?(?:the\s+)?public\s+domain"),
    ("all-rights-reserved", 35, "all rights reserved", r"all\s+rights\s+reserved"),
    ("proprietary", 45, "proprietary and confidential|confidential and proprietary", r"proprietary\s+and\s+confidential|confidential\s+and\s+proprietary"),
    ("non-commercial", 30, "non-commercial", r"(?:for\s+)?non-commercial\s+(?:use|purposes)(?:\s+only)?"),
    ("copyright-notice", 10, "copyright", r"copyright\s+(?:\(c\)|©)?\s*(?:19|20)\d\d"),
]
_GRANT = r"(?:licen[sc]ed|released|distributed|available|published|provided|covered)\s+(?:under|by)\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?"

#: A tag, with the operands of an expression that stand before the one sought.
_TAG = r"spdx-license-identifier:\s*(?:[\w.+()-]+\s+(?:and|or|with)\s+)*\(*"


def rules() -> list[Rule]:
    """All rules, the strongest first."""
    out = []
    for label, name, gates, spdx, url_gates, url in _FAMILIES:
        # Versions are more specific than their family; longer ids than shorter ones.
        own = 1 if label[-1].isdigit() else 0
        out += [
            Rule(label, 98 + own, ("spdx-license-identifier",), re.compile(rf"{_TAG}(?P<at>(?:{spdx})\+?)(?![\w.-])")),
            Rule(label, 88 + own, tuple(gates.split("|")), re.compile(rf"{_GRANT}(?:{name})(?!\w)")),
            Rule(label, 68 + own, tuple(url_gates.split("|")), re.compile(url)),
            Rule(label, 58 + own, tuple(gates.split("|")), re.compile(rf"(?<!\w)(?:{name})(?!\w)")),
        ]
    out += [Rule(label, p, tuple(gates.split("|")), re.compile(rx)) for label, p, gates, rx in _CLAUSES]
    return sorted(out, key=lambda r: (-r.priority, r.label, r.pattern.pattern))
