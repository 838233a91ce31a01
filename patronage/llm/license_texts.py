"""Notices, header lines and opening words of common licence families, as the licences word them."""

from __future__ import annotations

_FREE = ("This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name}"
         "General Public License as published by the Free Software Foundation, either version {version} of the "
         "License, or (at your option) any later version.")
_TITLE = ("GNU {name}GENERAL PUBLIC LICENSE Version {version}, {date} Copyright (C) {years} Free Software Foundation, "
          "Inc. {address} Everyone is permitted to copy and distribute verbatim copies of this license document, but "
          "changing it is not allowed.")
_STREET = "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"
_SITE = "<https://fsf.org/>"
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution.")
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_CC = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nc": "Attribution-NonCommercial",
       "by-nd": "Attribution-NoDerivatives", "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
       "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
_CC_VERSIONS = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
_SPDX = ("0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0",
         "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only",
         "GPL-3.0-or-later", "ISC", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
         "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib")

NOTICES: dict[str, str] = {
    "0bsd-text": f"{_ISC}.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl-3.0-notice": _FREE.format(what="program", name="Affero ", version="3"),
    "agpl-3.0-text": _TITLE.format(name="AFFERO ", version="3", date="19 November 2007", years="2007", address=_SITE),
    "apache-2.0-text": (
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION"),
    "bsd": "Released under the BSD License.",
    "bsd-2-clause-text": _BSD,
    "bsd-3-clause-text": (
        f"{_BSD} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."),
    "bsl-1.0-notice": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "http://www.boost.org/LICENSE_1_0.txt)"),
    "cc0-1.0": "Licensed under CC0 1.0.",
    "cc0-1.0-notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work."),
    "cc0-1.0-text": "Creative Commons Legal Code CC0 1.0 Universal",
    "epl-2.0-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-2.0-notice": _FREE.format(what="program", name="", version="2"),
    "gpl-2.0-only-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License version 2 as published by the Free Software Foundation."),
    "gpl-2.0-text": _TITLE.format(name="", version="2", date="June 1991", years="1989, 1991", address=_STREET),
    "gpl-3.0-text": _TITLE.format(name="", version="3", date="29 June 2007", years="2007", address=_SITE),
    "isc": "Released under the ISC License.",
    "isc-text": f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies.",
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-2.1-notice": _FREE.format(what="library", name="Lesser ", version="2.1"),
    "lgpl-2.1-text": _TITLE.format(name="LESSER ", version="2.1", date="February 1999", years="1991, 1999",
                                   address=_STREET),
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "lgpl-3.0-notice": _FREE.format(what="library", name="Lesser ", version="3"),
    "lgpl-3.0-text": _TITLE.format(name="LESSER ", version="3", date="29 June 2007", years="2007", address=_SITE),
    "mpl-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "mpl-2.0-text": (
        'Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that '
        "creates, contributes to the creation of, or owns Covered Software."),
    "unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."),
    "zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:"),
}
NOTICES |= {f"cc-{k}-4.0": f"Licensed under CC {k.upper()} 4.0." for k in _CC}
NOTICES |= {
    f"cc-{k}-{v}-notice": "This work is licensed under a Creative Commons {} {} {} License.".format(
        name if v == "4.0" else name.replace("NoDerivatives", "NoDerivs"), v, port)
    for k, name in _CC.items() for v, port in _CC_VERSIONS.items()}
NOTICES |= {
    f"cc-{k}-4.0-text": (
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of "
        f"this Creative Commons {name} 4.0 International Public License")
    for k, name in _CC.items()}
NOTICES |= {f"spdx-{k.lower()}": f"SPDX-License-Identifier: {k}" for k in _SPDX}
