r"""Hand-written signature rules of the license scanner, in order.

One rule a line: ``label | pattern``.  A pattern is tried on lower-cased texts that
have all strings that each of its matches contains.  In a pattern ``_`` stands for
white space, commas, quotes and line breaks between words (in a class for one such
character, an underscore is ``\x5f``), and every pattern is bounded on both sides by
a non-word character.  The sections give the priority: an earlier section suppresses
what a later one finds inside the same place.
"""

import re
from re import _constants as sre, _parser as parser

IDENTIFIERS = r"""
apache-2.0 | spdx-license-identifier:\s*apache-2\.0
apache-1.1 | spdx-license-identifier:\s*apache-1\.1
mit | spdx-license-identifier:\s*mit
mit-0 | spdx-license-identifier:\s*mit-0
bsd-2-clause | spdx-license-identifier:\s*bsd-2-clause
bsd-3-clause | spdx-license-identifier:\s*bsd-3-clause
bsd-4-clause | spdx-license-identifier:\s*bsd-4-clause
0bsd | spdx-license-identifier:\s*0bsd
gpl-1.0 | spdx-license-identifier:\s*gpl-1\.0(?:-only|-or-later|\+)?
gpl-2.0 | spdx-license-identifier:\s*gpl-2\.0(?:-only|-or-later|\+)?
gpl-3.0 | spdx-license-identifier:\s*gpl-3\.0(?:-only|-or-later|\+)?
lgpl-2.0 | spdx-license-identifier:\s*lgpl-2\.0(?:-only|-or-later|\+)?
lgpl-2.1 | spdx-license-identifier:\s*lgpl-2\.1(?:-only|-or-later|\+)?
lgpl-3.0 | spdx-license-identifier:\s*lgpl-3\.0(?:-only|-or-later|\+)?
agpl-3.0 | spdx-license-identifier:\s*agpl-3\.0(?:-only|-or-later|\+)?
mpl-1.1 | spdx-license-identifier:\s*mpl-1\.1
mpl-2.0 | spdx-license-identifier:\s*mpl-2\.0
epl-1.0 | spdx-license-identifier:\s*epl-1\.0
epl-2.0 | spdx-license-identifier:\s*epl-2\.0
cddl-1.0 | spdx-license-identifier:\s*cddl-1\.0
cddl-1.1 | spdx-license-identifier:\s*cddl-1\.1
isc | spdx-license-identifier:\s*isc
zlib | spdx-license-identifier:\s*zlib
unlicense | spdx-license-identifier:\s*unlicense
wtfpl | spdx-license-identifier:\s*wtfpl
bsl-1.0 | spdx-license-identifier:\s*bsl-1\.0
artistic-1.0 | spdx-license-identifier:\s*artistic-1\.0
artistic-2.0 | spdx-license-identifier:\s*artistic-2\.0
cc0-1.0 | spdx-license-identifier:\s*cc0-1\.0
cc-by-3.0 | spdx-license-identifier:\s*cc-by-3\.0
cc-by-4.0 | spdx-license-identifier:\s*cc-by-4\.0
cc-by-sa-3.0 | spdx-license-identifier:\s*cc-by-sa-3\.0
cc-by-sa-4.0 | spdx-license-identifier:\s*cc-by-sa-4\.0
cc-by-nc-4.0 | spdx-license-identifier:\s*cc-by-nc-4\.0
cc-by-nd-4.0 | spdx-license-identifier:\s*cc-by-nd-4\.0
ofl-1.1 | spdx-license-identifier:\s*ofl-1\.1
python-2.0 | spdx-license-identifier:\s*(?:python|psf)-2\.0
postgresql | spdx-license-identifier:\s*postgresql
ncsa | spdx-license-identifier:\s*ncsa
eupl-1.2 | spdx-license-identifier:\s*eupl-1\.2
osl-3.0 | spdx-license-identifier:\s*osl-3\.0
afl-3.0 | spdx-license-identifier:\s*afl-3\.0
ms-pl | spdx-license-identifier:\s*ms-pl
upl-1.0 | spdx-license-identifier:\s*upl-1\.0
mulanpsl-2.0 | spdx-license-identifier:\s*mulanpsl-2\.0
odbl-1.0 | spdx-license-identifier:\s*odbl-1\.0
busl-1.1 | spdx-license-identifier:\s*busl-1\.1
sspl-1.0 | spdx-license-identifier:\s*sspl-1\.0
elastic-2.0 | spdx-license-identifier:\s*elastic-2\.0
"""

ADDRESSES = r"""
apache-2.0 | https?://(?:www\.)?apache\.org/licenses/license-2\.0(?:\.txt|\.html)?
apache | https?://(?:www\.)?apache\.org/licenses/?
mit | https?://(?:www\.)?opensource\.org/licenses?/mit(?:-license)?(?:\.php|\.html)?
bsd-2-clause | https?://(?:www\.)?opensource\.org/licenses?/bsd-2-clause
bsd-3-clause | https?://(?:www\.)?opensource\.org/licenses?/bsd-3-clause
bsd | https?://(?:www\.)?opensource\.org/licenses?/bsd-license(?:\.php)?
isc | https?://(?:www\.)?opensource\.org/licenses?/isc(?:-license)?(?:\.txt)?
artistic-2.0 | https?://(?:www\.)?opensource\.org/licenses?/artistic-(?:license-)?2\.0(?:\.php)?
gpl-2.0 | https?://(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0(?:\.txt|\.html)?
gpl-3.0 | https?://(?:www\.)?gnu\.org/licenses/gpl-3\.0(?:\.txt|\.html)?
lgpl-2.1 | https?://(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1(?:\.txt|\.html)?
lgpl-3.0 | https?://(?:www\.)?gnu\.org/licenses/lgpl-3\.0(?:\.txt|\.html)?
agpl-3.0 | https?://(?:www\.)?gnu\.org/licenses/agpl-3\.0(?:\.txt|\.html)?
gfdl | https?://(?:www\.)?gnu\.org/(?:licenses|copyleft)/fdl(?:-1\.[123])?(?:\.txt|\.html)?
gpl | https?://(?:www\.)?gnu\.org/(?:licenses|copyleft)/(?:gpl\.(?:txt|html))?
mpl-1.1 | https?://(?:www\.)?mozilla\.org/mpl/(?:mpl-1\.1(?:\.txt|\.html)?|1\.1/?)
mpl-2.0 | https?://(?:www\.)?mozilla\.org/(?:[a-z-]+/)?mpl/2\.0/?
epl-1.0 | https?://(?:www\.)?eclipse\.org/legal/epl-v10(?:\.html)?
epl-2.0 | https?://(?:www\.)?eclipse\.org/legal/epl-(?:v20|2\.0)(?:\.html)?/?
cc0-1.0 | https?://creativecommons\.org/publicdomain/zero/1\.0/?
public-domain | https?://creativecommons\.org/publicdomain/mark/1\.0/?
cc-by-nc-nd-4.0 | https?://creativecommons\.org/licenses/by-nc-nd/4\.0(?:/[a-z.]*)?
cc-by-nc-nd-3.0 | https?://creativecommons\.org/licenses/by-nc-nd/3\.0(?:/[a-z.]*)?
cc-by-nc-sa-4.0 | https?://creativecommons\.org/licenses/by-nc-sa/4\.0(?:/[a-z.]*)?
cc-by-nc-sa-3.0 | https?://creativecommons\.org/licenses/by-nc-sa/3\.0(?:/[a-z.]*)?
cc-by-nc-4.0 | https?://creativecommons\.org/licenses/by-nc/4\.0(?:/[a-z.]*)?
cc-by-nc-3.0 | https?://creativecommons\.org/licenses/by-nc/3\.0(?:/[a-z.]*)?
cc-by-nd-4.0 | https?://creativecommons\.org/licenses/by-nd/4\.0(?:/[a-z.]*)?
cc-by-nd-3.0 | https?://creativecommons\.org/licenses/by-nd/3\.0(?:/[a-z.]*)?
cc-by-sa-4.0 | https?://creativecommons\.org/licenses/by-sa/4\.0(?:/[a-z.]*)?
cc-by-sa-3.0 | https?://creativecommons\.org/licenses/by-sa/3\.0(?:/[a-z.]*)?
cc-by-sa-2.5 | https?://creativecommons\.org/licenses/by-sa/2\.5(?:/[a-z.]*)?
cc-by-4.0 | https?://creativecommons\.org/licenses/by/4\.0(?:/[a-z.]*)?
cc-by-3.0 | https?://creativecommons\.org/licenses/by/3\.0(?:/[a-z.]*)?
cc-by-2.5 | https?://creativecommons\.org/licenses/by/2\.5(?:/[a-z.]*)?
cc-by-2.0 | https?://creativecommons\.org/licenses/by/2\.0(?:/[a-z.]*)?
unlicense | https?://(?:www\.)?unlicense\.org/?
wtfpl | https?://(?:www\.)?wtfpl\.net/(?:about|txt/copying)?/?
bsl-1.0 | https?://(?:www\.)?boost\.org/license\x5f1\x5f0\.txt
zlib | https?://(?:www\.)?zlib\.net/zlib\x5flicense\.html
ofl-1.1 | https?://scripts\.sil\.org/ofl
odbl-1.0 | https?://(?:www\.)?opendatacommons\.org/licenses/odbl(?:/1[.-]0)?/?
odc-by-1.0 | https?://(?:www\.)?opendatacommons\.org/licenses/by(?:/1[.-]0)?/?
pddl-1.0 | https?://(?:www\.)?opendatacommons\.org/licenses/pddl(?:/1[.-]0)?/?
python-2.0 | https?://(?:www\.)?python\.org/psf/license/?
eupl-1.2 | https?://(?:joinup|eupl)\.(?:ec\.europa\.)?eu/\S{0,80}eupl\S{0,40}
elastic-2.0 | https?://(?:www\.)?elastic\.co/licensing/elastic-license
sspl-1.0 | https?://(?:www\.)?mongodb\.com/(?:legal/)?licensing/server-side-public-license
"""

NOTICES = r"""
apache-2.0 | licensed_under_the_apache_license_version_2(?:\.0)?
apache-1.1 | licensed_under_the_apache_(?:software_)?license_version_1\.1
apache-2.0 | (?:released|distributed|available|published)_under_(?:the_)?(?:terms_of_the_)?apache_license_(?:version_)?2(?:\.0)?
gpl-3.0 | licensed_under_the_gnu_general_public_license_version_3(?:\.0)?
gpl-2.0 | licensed_under_the_gnu_general_public_license_version_2(?:\.0)?
gpl-3.0 | terms_of_the_gnu_general_public_license_as_published_by_the_free_software_foundation_(?:either_)?version_3
gpl-2.0 | terms_of_the_gnu_general_public_license_as_published_by_the_free_software_foundation_(?:either_)?version_2
lgpl-2.1 | terms_of_the_gnu_lesser_general_public_license_as_published_by_the_free_software_foundation_(?:either_)?version_2\.1
lgpl-3.0 | terms_of_the_gnu_lesser_general_public_license_as_published_by_the_free_software_foundation_(?:either_)?version_3
agpl-3.0 | terms_of_the_gnu_affero_general_public_license_as_published_by_the_free_software_foundation_(?:either_)?version_3
lgpl | licensed_under_the_gnu_lesser_general_public_license
agpl | licensed_under_the_gnu_affero_general_public_license
gfdl | under_the_terms_of_the_gnu_free_documentation_license
mit | licensed_under_the_(?:terms_of_the_)?mit_license
mit | (?:released|distributed|available|published)_under_(?:the_)?(?:terms_of_the_)?mit_license
mit | permission_is_hereby_granted_free_of_charge_to_any_person_obtaining_a_copy_of_this_software_and_associated_documentation_files
isc | permission_to_use_copy_modify_and(?:/or)?_distribute_this_software_for_any_purpose_with_or_without_fee_is_hereby_granted
bsd | redistribution_and_use_in_source_and_binary_forms_with_or_without_modification_are_permitted
bsd | licensed_under_the_(?:terms_of_the_)?(?:new_|modified_|simplified_)?bsd_license
mpl-2.0 | this_source_code_form_is_subject_to_the_terms_of_the_mozilla_public_license_v(?:ersion)?[._ ]*2\.0
mpl-1.1 | subject_to_the_mozilla_public_license_version_1\.1
epl-2.0 | terms_of_the_eclipse_public_license_(?:v|version_)?_?2\.0
epl-1.0 | terms_of_the_eclipse_public_license_(?:v|version_)?_?1\.0
cddl-1.0 | subject_to_the_terms_of_the_common_development_and_distribution_license
bsl-1.0 | distributed_under_the_boost_software_license_version_1\.0
zlib | this_software_is_provided_as-is_without_any_express_or_implied_warranty
unlicense | this_is_free_and_unencumbered_software_released_into_the_public_domain
wtfpl | do_what_the_fuck_you_want_to_public_license
public-domain | (?:released|placed|dedicated)_(?:in|into|to)_the_public_domain
cc-by-nc-nd-4.0 | creative_commons_attribution-noncommercial-noderiv(?:ative)?s_4\.0
cc-by-nc-sa-4.0 | creative_commons_attribution-noncommercial-sharealike_4\.0
cc-by-nc-4.0 | creative_commons_attribution-noncommercial_4\.0
cc-by-sa-4.0 | creative_commons_attribution-share-?alike_4\.0
cc-by-sa-3.0 | creative_commons_attribution-share-?alike_3\.0
cc-by-4.0 | creative_commons_attribution_4\.0
cc-by-3.0 | creative_commons_attribution_3\.0
cc0-1.0 | cc0_1\.0_universal
cc-by | licensed_under_(?:a_|the_)?cc[- ]by
cc-by-sa | licensed_under_(?:a_|the_)?cc[- ]by[- ]sa
cc-by-4.0 | licensed_under_(?:a_|the_)?cc[- ]by[- ]4\.0
cc-by-sa-4.0 | licensed_under_(?:a_|the_)?cc[- ]by[- ]sa[- ]4\.0
ofl-1.1 | licensed_under_the_sil_open_font_license_version_1\.1
artistic-2.0 | terms_of_the_(?:perl_)?artistic_license_(?:version_)?2\.0
python-2.0 | python_software_foundation_license_(?:agreement|version_2)
postgresql | (?:licensed|released)_under_the_postgresql_license
busl-1.1 | licensed_under_the_business_source_license_1\.1
elastic-2.0 | licensed_under_the_elastic_license_2\.0
sspl-1.0 | licensed_under_the_server_side_public_license
proprietary | (?:this_(?:file|document|software|work)_(?:is|contains)_)?confidential_and_proprietary(?:_information)?
proprietary | unauthorized_(?:copying|reproduction|distribution)_(?:or_distribution_)?of_this_(?:file|document|software|work|text)
"""

NAMES = r"""
apache-2.0 | apache_license_(?:version_|v)?_?2(?:\.0)?
apache-2.0 | apache[- ]2\.0
apache-1.1 | apache_(?:software_)?license_(?:version_|v)?_?1\.1
apache | (?:the_)?apache_(?:software_)?license
gpl-3.0 | gnu_general_public_license_(?:version_|v)_?3(?:\.0)?
gpl-2.0 | gnu_general_public_license_(?:version_|v)_?2(?:\.0)?
gpl-1.0 | gnu_general_public_license_(?:version_|v)_?1(?:\.0)?
gpl | gnu_general_public_license
gpl-3.0 | gplv3\+?
gpl-2.0 | gplv2\+?
gpl-3.0 | gpl[- ](?:version_|v)?3(?:\.0)?\+?
gpl-2.0 | gpl[- ](?:version_|v)?2(?:\.0)?\+?
gpl | (?:the_)?gnu_gpl
lgpl-2.1 | (?:gnu_)?lesser_general_public_license_(?:version_|v)_?2\.1
lgpl-3.0 | (?:gnu_)?lesser_general_public_license_(?:version_|v)_?3(?:\.0)?
lgpl-2.0 | (?:gnu_)?library_general_public_license_(?:version_|v)_?2(?:\.0)?
lgpl | (?:gnu_)?lesser_general_public_license
lgpl | (?:gnu_)?library_general_public_license
lgpl-2.1 | lgplv2(?:\.1)?\+?
lgpl-3.0 | lgplv3\+?
lgpl-2.1 | lgpl[- ](?:version_|v)?2\.1\+?
lgpl-3.0 | lgpl[- ](?:version_|v)?3(?:\.0)?\+?
agpl-3.0 | (?:gnu_)?affero_general_public_license_(?:version_|v)_?3(?:\.0)?
agpl | (?:gnu_)?affero_general_public_license
agpl-3.0 | agplv3\+?
agpl-3.0 | agpl[- ](?:version_|v)?3(?:\.0)?\+?
gfdl | (?:gnu_)?free_documentation_license
gfdl | gfdl
mit | (?:the_)?mit_license
mit | (?:the_)?expat_license
mit | (?:the_)?(?:mit/)?x11_license
mit-0 | mit_no_attribution
bsd-2-clause | (?:bsd[- ]2|2)[- ]clause(?:_bsd)?(?:_license)?
bsd-3-clause | (?:bsd[- ]3|3)[- ]clause(?:_bsd)?(?:_license)?
bsd-4-clause | (?:bsd[- ]4|4)[- ]clause(?:_bsd)?(?:_license)?
bsd-2-clause | simplified_bsd(?:_license)?
bsd-2-clause | freebsd_license
bsd-3-clause | (?:new|modified|revised)_bsd_license
bsd-4-clause | original_bsd_license
0bsd | zero-clause_bsd(?:_license)?
bsd | (?:the_)?bsd_license
mpl-2.0 | mozilla_public_license_(?:version_|v)?[._ ]*2\.0
mpl-1.1 | mozilla_public_license_(?:version_|v)?[._ ]*1\.1
mpl | mozilla_public_license
mpl-2.0 | mpl[- ](?:v)?2\.0
epl-2.0 | eclipse_public_license_(?:version_|v)?[._ -]*2\.0
epl-1.0 | eclipse_public_license_(?:version_|v)?[._ -]*1\.0
epl | eclipse_public_license
cddl-1.0 | common_development_and_distribution_license
isc | isc_license
zlib | (?:zlib/libpng|zlib)_license
bsl-1.0 | boost_software_license
unlicense | (?:the_)?unlicense
wtfpl | wtfpl
artistic-2.0 | artistic_license_(?:version_|v)?_?2\.0
artistic-1.0 | artistic_license_(?:version_|v)?_?1\.0
artistic | perl_artistic_license
cc0-1.0 | cc0(?:[- ]1\.0)?
cc-by-nc-nd | cc[- ]by[- ]nc[- ]nd(?:[- ][1-4]\.[05])?
cc-by-nc-sa | cc[- ]by[- ]nc[- ]sa(?:[- ][1-4]\.[05])?
cc-by-nc | cc[- ]by[- ]nc(?:[- ][1-4]\.[05])?
cc-by-nd | cc[- ]by[- ]nd(?:[- ][1-4]\.[05])?
cc-by-sa | cc[- ]by[- ]sa(?:[- ][1-3]\.[05])?
cc-by-sa-4.0 | cc[- ]by[- ]sa[- ]4\.0
cc-by-4.0 | cc[- ]by[- ]4\.0
cc-by-3.0 | cc[- ]by[- ]3\.0
cc-by-2.5 | cc[- ]by[- ]2\.5
cc-by | cc[- ]by
cc-by-sa | creative_commons_attribution[- ]share-?alike(?:_license)?
cc-by-nc | creative_commons_attribution[- ]non-?commercial(?:_license)?
cc-by-nd | creative_commons_attribution[- ]no-?deriv(?:ative)?s?(?:_license)?
cc-by | creative_commons_attribution_license
ofl-1.1 | sil_open_font_license
python-2.0 | psf_license(?:_agreement)?
postgresql | postgresql_license
ncsa | university_of_illinois/ncsa_open_source_license
eupl-1.2 | european_union_public_licen[cs]e
eupl-1.2 | eupl(?:[- ]v?1\.2)?
osl-3.0 | open_software_license(?:_(?:version_|v)?_?3\.0)?
afl-3.0 | academic_free_license(?:_(?:version_|v)?_?3\.0)?
ms-pl | microsoft_public_license
ms-rl | microsoft_reciprocal_license
upl-1.0 | universal_permissive_license
mulanpsl-2.0 | mulan_permissive_software_license
odbl-1.0 | open_(?:data_commons_open_)?database_license
odc-by-1.0 | open_data_commons_attribution_license
pddl-1.0 | public_domain_dedication_and_license
busl-1.1 | business_source_license
sspl-1.0 | server[- ]side_public_license
elastic-2.0 | elastic_license(?:_2\.0)?
commons-clause | commons_clause(?:_license_condition)?
beerware | (?:the_)?beer-?ware_license
json | software_shall_be_used_for_good_not_evil
openssl | openssl_license
php-3.01 | php_license(?:_version_3\.0?1)?
ruby | ruby_license
vim | vim_license
curl | curl_license
w3c | w3c_software(?:_notice_and)?_license
unicode | unicode_license_agreement
openrail | (?:creativeml_)?(?:big)?(?:code-)?open-?rail(?:-m|\+\+)?(?:_license)?
llama | llama(?:_[2-4](?:\.\d)?)?_community_license(?:_agreement)?
"""

HINTS = r"""
proprietary | all_rights_reserved
public-domain | public_domain
copyleft | copyleft
royalty-free | royalty-free
open-source | open[- ]source_licen[cs]e
free-software | free_software_licen[cs]e
"""

#: (rules, weight of a detection) in order of priority.
SECTIONS = ((IDENTIFIERS, 1.0), (NOTICES, 0.95), (ADDRESSES, 0.9), (NAMES, 0.75), (HINTS, 0.4))


_GAP = r"""\s,;"'()"""


def contained(parsed) -> set[str]:
    """Strings of two characters or more that every match of a parsed pattern contains."""
    out, run = set(), ""
    for op, arg in parsed:
        if op is sre.LITERAL:
            run += chr(arg)
            continue
        out.add(run)
        run = ""
        if op is sre.SUBPATTERN:
            out |= contained(arg[-1])
        elif op is sre.MAX_REPEAT and arg[0]:
            out |= contained(arg[-1])
        elif op is sre.BRANCH:
            out |= set.intersection(*map(contained, arg[1]))
    return {x for x in out | {run} if len(x) > 1}


def rules() -> list[tuple[str, list[str], str, int, float]]:
    """(label, strings that all matches contain, pattern, priority, weight), in order."""
    out = []
    for priority, (text, weight) in enumerate(SECTIONS):
        for line in text.strip().splitlines():
            label, pattern = (x.strip() for x in line.split(" | ", 1))
            pattern = re.sub(r"\[[^\]]*\]|_", lambda m: f"(?:[{_GAP}]++)" if m[0] == "_" else m[0].replace("_", _GAP), pattern)
            out.append((label, sorted(contained(parser.parse(pattern))), pattern, priority, weight))
    return out
