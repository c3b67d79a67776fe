"""License scans by canonical digest: a text and the known licences are
normalised alike, and the digests of entire texts are joined.

Normalising lowers A-Z, leaves out copyright claims, replaces runs of ASCII
punctuation and white space by blanks, and takes one of several equivalent
spellings of a word. All of it is DataFrame functions.

A claim is a line of at most ``CLAIM_CHARS`` characters that, after comment
marks, begins with a mark of copyright and a year, holder or blank to fill in,
or consists of 'all rights reserved'; a claim with a year or ``(c)`` before the
opening words of a licence on the same line; or a claim in a licence's own text
(the Free Software Foundation's, or blanks to fill in), wherever it stands.
Other mentions of copyright are wording and stay, so the digest does not depend
on how a text is wrapped. A claim inside a line that no opening words follow
stays too: where its holder ends cannot be told.

The oracle in SQL drops every line with one of ``COPYRIGHT_MARKS``. Where such
lines are claims both agree, as on the given tables; it is no oracle for others.

A null text counts as empty. A text that is empty after normalising matches
nothing. A licence with several known texts, or texts with one digest, give one
row for each document: the first id in order. Repeated rows and ids stay; extra
columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import json
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Spellings that count as equal, and the one that stands for them.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "acknowledgement": "acknowledgment",
    "analogue": "analog", "artefact": "artifact", "authorisation": "authorization", "authorised": "authorized",
    "cancelled": "canceled", "centre": "center", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "initialise": "initialize", "judgement": "judgment", "labour": "labor", "merchantibility": "merchantability",
    "noncommercial": "non-commercial", "organisation": "organization", "organisations": "organizations",
    "organised": "organized", "percent": "per cent", "programme": "program", "recognise": "recognize", "utilisation": "utilization",
    "whilst": "while", "wilful": "willful",
}
#: Further equal spellings, taken after those above; the oracle has only those above.
MORE_SPELLINGS = {
    "licencing": "licensing", "licencee": "licensee", "licencees": "licensees", "licencor": "licensor", "sublicence": "sublicense",
    "sublicences": "sublicenses", "sublicenced": "sublicensed", "sublicencing": "sublicensing", "sub license": "sublicense",
    "sub licenses": "sublicenses", "sub licensed": "sublicensed", "sub licensing": "sublicensing",
    "copyright owner": "copyright holder", "copyright owners": "copyright holders", "https": "http",
    "acknowledgements": "acknowledgments", "analyse": "analyze", "artefacts": "artifacts", "authorise": "authorize",
    "calibre": "caliber", "cancelling": "canceling", "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize",
    "emphasised": "emphasized", "favours": "favors", "fulfilment": "fulfillment", "initialised": "initialized",
    "judgements": "judgments", "labelling": "labeling", "maximise": "maximize", "modelled": "modeled", "modelling": "modeling",
    "offence": "offense", "offences": "offenses", "optimise": "optimize", "organise": "organize", "practise": "practice",
    "programmes": "programs", "realise": "realize", "recognised": "recognized", "signalling": "signaling", "utilise": "utilize", "wilfull": "willful",
}
COPYRIGHT_MARKS = ["copyright", "(c)", "©", "all rights reserved"]
CLAIM_CHARS = 200
#: What shows that a text may claim copyright.
_MARKED = r"(?i)copyright|\(c\)|©|&copy;|all rights reserved"
_SIGN, _YEAR = r"(?:\(c\)|©|&copy;)", r"(?:(?:19|20)\d\d|\d?[\[<{](?:yyyy|years?|dates?|copyright|owner|name))"
_BEGUN = rf"(?:copyright[\s:,-]*{_SIGN}|copyright[\s:,-]*{_YEAR}|{_SIGN}[\s:,-]*(?:copyright[\s:,-]*)?{_YEAR})"
#: Words after a capital 'Copyright' that are no holder.
_NO_HOLDER = (r"(?!(?i:(?:notice|holder|owner|statement|interest|right|disclaimer|licen[cs]|protect|treat|claim|polic)\w*|"
              r"laws?|acts?|and|or|in|of|each|every|any|all|no|this|you|your|as|is)\b)")
_HOLDER = rf"(?:{_SIGN}\s*)?Copyright[\s:,-]*(?:by\s+)?(?:[Tt]he\s+)?{_NO_HOLDER}[A-Z][a-z]"
_COMMENT = r"[\s/*#;%!'\"<>|:.=~+-]*(?:(?i:dnl|rem)\s+)?"
_CLAIM = rf"^{_COMMENT}(?:(?i:{_BEGUN}|©|&copy;)|{_HOLDER}|(?i:all rights reserved)\W*$)"
_OPENING = (r"permission\s+is\s+(?:hereby\s+)?granted|permission\s+to\s+use|redistribution\s+and\s+use|licensed\s+under|everyone\s+is\s+permitted|"
            r"this\s+(?:program|library|software|font\s+software)\s+is")
_BEFORE_OPENING = rf"(?i)\b{_BEGUN}[^\n]{{0,{CLAIM_CHARS}}}?(?:all\s+rights\s+reserved[.\s]*)?(?={_OPENING})"
#: Runs of blanks are never given back, so that a long run costs its length once.
_OWN_CLAIM = (
    r"(?i)copyright(?:\s++\(c\))?+(?:"
    r"(?=\s[\d,\s])[\d,\s]++free\s++software\s++foundation,\s++inc\.,?(?:\s+<https?://(?:www\.)?fsf\.org/?>)?"
    r"(?:\s+5[19]\s+(?:franklin\s+st(?:reet)?,\s+fifth\s+floor|temple\s+place,?\s+-?\s*suite\s+330),\s+boston,\s+ma\s+0211\d-130\d,?\s+usa)?|"
    r"\s++\[yyyy\]\s+\[name\s+of\s+copyright\s+owner\]|\s++(?:<?year>?|19[xy]{2})\s+(?:<name\s+of\s+author>|name\s+of\s+author|your\s+name)|\s++_+)")
PUNCTUATION = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"

#: Known licences and notices, as their public texts state them; ``licences.json`` has more.
KNOWN = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT-notice", "Released under the MIT License."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
]


def canonical(text: Column) -> Column:
    """The normalised text: words with two blanks around each."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    inner = F.regexp_replace(F.regexp_replace(text, _OWN_CLAIM, " "), _BEFORE_OPENING, " ")
    lines = F.filter(F.split(inner, "\n"), lambda line: ~((F.length(line) <= CLAIM_CHARS) & line.rlike(_CLAIM)))
    kept = F.when(text.rlike(_MARKED), F.array_join(lines, " ")).otherwise(text)
    small = F.translate(kept, CAPITALS, SMALL)
    words = F.regexp_replace(F.concat(F.lit(" "), small, F.lit(" ")), PUNCTUATION, "  ")
    for spelling, common in [*SPELLINGS.items(), *MORE_SPELLINGS.items()]:
        words = F.replace(words, F.lit(f" {spelling.replace(' ', '  ')} "), F.lit(f" {common.replace('-', '  ').replace(' ', '  ')} "))
    return words


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_licences(spark: SparkSession) -> DataFrame:
    """``license_id, text``: ``KNOWN``, and the full texts in ``licences.json``
    without a title and with each of their usual titles."""
    rows = list(KNOWN)
    for licence in json.loads(files(__package__).joinpath("licences.json").read_text("utf-8")):
        rows += [(licence["license_id"], f"{title}\n\n{text}") for title in ["", *licence["titles"]] for text in licence["texts"]]
    return spark.createDataFrame(rows, "license_id string, text string")


def scan(docs: DataFrame, licences: DataFrame) -> DataFrame:
    """``doc_id``, the ``digest`` of the normalised text and the ``license_id``
    of an equal known text (``licences``: ``license_id``, ``text``), else null."""
    known = (licences.select("license_id", digest(F.col("text")).alias("digest"), canonical(F.col("text")).alias("words"))
             .where("trim(words) <> ''").groupBy("digest").agg(F.min("license_id").alias("license_id")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"))
    return texts.join(known, "digest", "left").select("doc_id", "digest", "license_id")


def oracle_sql() -> str:
    """The scan of ``documents`` in DuckDB SQL."""
    words = f"translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}')"
    unmarked = " and ".join(f"not contains(line, '{m}')" for m in COPYRIGHT_MARKS)
    words = f"array_to_string(list_filter(string_split({words}, chr(10)), lambda line: {unmarked}), ' ')"
    words = f"regexp_replace(' ' || {words} || ' ', '{PUNCTUATION}', '  ', 'g')"
    for spelling, common in SPELLINGS.items():
        words = f"replace({words}, ' {spelling} ', ' {common.replace('-', '  ').replace(' ', '  ')} ')"
    rows = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN)
    return f"""with known as (select license_id, {words} as words from (values {rows}) v(license_id, text)),
      ids as (select sha256(words) as digest, min(license_id) as license_id from known where trim(words) <> '' group by 1),
      texts as (select doc_id, sha256({words}) as digest from documents)
      select doc_id, texts.digest, license_id from texts left join ids on texts.digest = ids.digest"""
