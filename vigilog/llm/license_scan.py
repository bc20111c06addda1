"""License detection by ordered signature rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.llm.text import lower_ascii
from vigilog.session import durable

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases whose places are counted, and their labels.
BASE = (("mit", "under the mit license", "mit"),
        ("apache-2", "apache license version 2", "apache"),
        ("cc-by-nc", "cc by nc", "nc"))

# Public license names: label, name pattern, SPDX id, address, keyword of the name, keyword of the address.
# All over words in lower case with one blank between; a keyword is a word, or a part of one, of every match.
_V = r"(?: version| v| v\. ?)?"
LICENSES = (
    ("mit", r"(?:mit|expat|x11) licen[sc]e", "mit", r"opensource org licenses? mit", "licen", "opensource"),
    ("mit-0", r"mit no attribution(?: licen[sc]e)?", "mit 0", r"github com aws mit 0", "attribution", "github"),
    ("apache-2", rf"apache(?: software)? licen[sc]e{_V} ?2(?: 0)?", "apache 2 0", r"apache org licenses license 2 0", "apache", "apache"),
    ("apache-1.1", rf"apache(?: software)? licen[sc]e{_V} 1 1", "apache 1 1", r"apache org licenses license 1 1", "apache", "apache"),
    ("apache-1.0", rf"apache(?: software)? licen[sc]e{_V} 1 0", "apache 1 0", r"apache org licenses license 1 0", "apache", "apache"),
    ("apache", r"apache(?: software)? licen[sc]e", "apache", r"apache org licenses", "apache", "apache"),
    ("bsd-2-clause", r"(?:simplified bsd licen[sc]e|bsd 2 clause(?: licen[sc]e)?|2 clause bsd(?: licen[sc]e)?)", "bsd 2 clause", r"opensource org licenses? bsd 2 clause", "bsd", "bsd"),
    ("bsd-3-clause", r"(?:(?:new|modified|revised) bsd licen[sc]e|bsd 3 clause(?: licen[sc]e)?|3 clause bsd(?: licen[sc]e)?)", "bsd 3 clause", r"opensource org licenses? bsd 3 clause", "bsd", "bsd"),
    ("bsd-4-clause", r"(?:original bsd licen[sc]e|bsd 4 clause(?: licen[sc]e)?|4 clause bsd(?: licen[sc]e)?)", "bsd 4 clause", r"directory fsf org wiki license bsd 4clause", "bsd", "4clause"),
    ("0bsd", r"(?:zero clause bsd(?: licen[sc]e)?|bsd zero clause licen[sc]e|0bsd)", "0bsd", r"opensource org licenses? 0bsd", "bsd", "0bsd"),
    ("bsd", r"bsd(?: style)? licen[sc]e", "bsd", r"opensource org licenses? bsd license", "bsd", "bsd"),
    ("isc", r"isc licen[sc]e", "isc", r"opensource org licenses? isc", "licen", "isc"),
    ("gpl-1", rf"gnu general public licen[sc]e{_V} 1(?: 0)?", "gpl 1 0(?: only| or later)?", r"gnu org licenses old licenses gpl 1 0", "gnu", "gpl"),
    ("gpl-2", rf"(?:gnu general public licen[sc]e{_V} 2(?: 0)?|gnu gpl{_V} ?2(?: 0)?|gpl{_V} ?2(?: 0)?|gplv2)", "gpl 2 0(?: only| or later)?", r"gnu org licenses(?: old licenses)? gpl 2 0", "g", "gpl"),
    ("gpl-3", rf"(?:gnu general public licen[sc]e{_V} 3(?: 0)?|gnu gpl{_V} ?3(?: 0)?|gpl{_V} ?3(?: 0)?|gplv3)", "gpl 3 0(?: only| or later)?", r"gnu org licenses gpl 3 0", "g", "gpl"),
    ("gpl", r"(?:gnu general public licen[sc]e|gnu gpl|gpl)", "gpl", r"gnu org (?:copyleft|licenses) gpl", "g", "gpl"),
    ("lgpl-2", rf"(?:gnu library general public licen[sc]e{_V} 2(?: 0)?|lgpl{_V} ?2(?: 0)?)", "lgpl 2 0(?: only| or later)?", r"gnu org licenses old licenses lgpl 2 0", "g", "lgpl"),
    ("lgpl-2.1", rf"(?:gnu lesser general public licen[sc]e{_V} 2 1|lgpl{_V} ?2 1)", "lgpl 2 1(?: only| or later)?", r"gnu org licenses(?: old licenses)? lgpl 2 1", "g", "lgpl"),
    ("lgpl-3", rf"(?:gnu lesser general public licen[sc]e{_V} 3(?: 0)?|lgpl{_V} ?3(?: 0)?)", "lgpl 3 0(?: only| or later)?", r"gnu org licenses lgpl 3 0", "g", "lgpl"),
    ("lgpl", r"(?:gnu (?:lesser|library) general public licen[sc]e|gnu lgpl|lgpl)", "lgpl", r"gnu org (?:copyleft|licenses) lgpl", "g", "lgpl"),
    ("agpl-3", rf"(?:gnu affero general public licen[sc]e{_V} 3(?: 0)?|agpl{_V} ?3(?: 0)?)", "agpl 3 0(?: only| or later)?", r"gnu org licenses agpl 3 0", "g", "agpl"),
    ("agpl", r"(?:gnu affero general public licen[sc]e|affero general public licen[sc]e|agpl)", "agpl", r"gnu org licenses agpl", "g", "agpl"),
    ("gfdl", r"(?:gnu free documentation licen[sc]e|gfdl)", "gfdl 1 [123](?: only| or later)?", r"gnu org (?:copyleft|licenses) fdl", "f", "fdl"),
    ("mpl-2", rf"mozilla public licen[sc]e{_V} 2(?: 0)?", "mpl 2 0", r"mozilla org (?:en us )?mpl 2 0", "mozilla", "mpl"),
    ("mpl-1.1", rf"mozilla public licen[sc]e{_V} 1 1", "mpl 1 1", r"mozilla org (?:en us )?mpl 1 1", "mozilla", "mpl"),
    ("mpl", r"mozilla public licen[sc]e", "mpl", r"mozilla org (?:en us )?mpl", "mozilla", "mpl"),
    ("epl-2", rf"eclipse public licen[sc]e{_V} 2(?: 0)?", "epl 2 0", r"eclipse org legal epl 2 0", "eclipse", "epl"),
    ("epl-1", rf"eclipse public licen[sc]e{_V} 1(?: 0)?", "epl 1 0", r"eclipse org legal epl v10", "eclipse", "epl"),
    ("edl", r"eclipse distribution licen[sc]e", "bsd 3 clause eclipse", r"eclipse org org documents edl", "eclipse", "edl"),
    ("cddl", r"common development and distribution licen[sc]e(?: 1 [01])?", "cddl 1 [01]", r"opensource org licenses? cddl", "distribution", "cddl"),
    ("cpl", r"common public licen[sc]e(?: 1 0)?", "cpl 1 0", r"opensource org licenses? cpl", "common", "cpl"),
    ("eupl", rf"european union public licen[sc]e{_V}(?: 1 [12])?", "eupl 1 [012]", r"joinup ec europa eu .{0,40}?eupl", "european", "eupl"),
    ("artistic-2", rf"artistic licen[sc]e{_V} 2(?: 0)?", "artistic 2 0", r"opensource org licenses? artistic 2 0", "artistic", "artistic"),
    ("artistic", r"artistic licen[sc]e", "artistic 1 0", r"opensource org licenses? artistic", "artistic", "artistic"),
    ("bsl-1", r"boost software licen[sc]e(?: version)?(?: 1 0)?", "bsl 1 0", r"boost org license 1 0", "boost", "boost"),
    ("zlib", r"zlib(?: libpng)? licen[sc]e", "zlib", r"zlib net zlib license", "zlib", "zlib"),
    ("libpng", r"libpng licen[sc]e", "libpng 2 0", r"libpng org pub png src libpng license", "libpng", "libpng"),
    ("unlicense", r"(?:the )?unlicen[sc]e", "unlicense", r"unlicense org", "unlicen", "unlicen"),
    ("wtfpl", r"(?:wtfpl|do what the fuck you want to public licen[sc]e)", "wtfpl", r"wtfpl net", "f", "wtfpl"),
    ("python-2", r"(?:python software foundation|psf) licen[sc]e(?: version)?(?: 2)?", "(?:python|psf) 2 0", r"python org psf license", "licen", "python"),
    ("ruby", r"ruby licen[sc]e", "ruby", r"ruby lang org en about license", "ruby", "ruby"),
    ("php-3", r"php licen[sc]e(?: version)?(?: 3(?: 0[01])?)?", "php 3 (?:0|01)", r"php net license", "php", "php"),
    ("postgresql", r"postgresql licen[sc]e", "postgresql", r"postgresql org about licence", "postgresql", "postgresql"),
    ("openssl", r"openssl licen[sc]e", "openssl", r"openssl org source license", "openssl", "openssl"),
    ("ofl-1.1", r"sil open font licen[sc]e(?: version)?(?: 1 [01])?", "ofl 1 1", r"scripts sil org ofl", "font", "ofl"),
    ("ncsa", r"university of illinois ncsa open source licen[sc]e", "ncsa", r"opensource org licenses? ncsa", "ncsa", "ncsa"),
    ("ms-pl", r"microsoft public licen[sc]e", "ms pl", r"opensource org licenses? ms pl", "microsoft", "opensource"),
    ("ms-rl", r"microsoft reciprocal licen[sc]e", "ms rl", r"opensource org licenses? ms rl", "microsoft", "opensource"),
    ("osl-3", r"open software licen[sc]e(?: version| v)?(?: 3 0)?", "osl 3 0", r"opensource org licenses? osl 3 0", "software", "osl"),
    ("afl-3", r"academic free licen[sc]e(?: version| v)?(?: 3 0)?", "afl 3 0", r"opensource org licenses? afl 3 0", "academic", "afl"),
    ("cc0", r"(?:cc0(?: 1 0)?|creative commons zero(?: 1 0)?)", "cc0 1 0", r"creativecommons org publicdomain zero", "c", "creativecommons"),
    ("cc-by-nc-nd", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)(?: [1-4] [05])?", "cc by nc nd [1-4] [05]", r"creativecommons org licenses by nc nd", "c", "creativecommons"),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1-4] [05])?", "cc by nc sa [1-4] [05]", r"creativecommons org licenses by nc sa", "c", "creativecommons"),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)(?: [1-4] [05])?", "cc by nc [1-4] [05]", r"creativecommons org licenses by nc", "c", "creativecommons"),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)(?: [1-4] [05])?", "cc by nd [1-4] [05]", r"creativecommons org licenses by nd", "c", "creativecommons"),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)(?: [1-4] [05])?", "cc by sa [1-4] [05]", r"creativecommons org licenses by sa", "c", "creativecommons"),
    ("cc-by", r"(?:cc by|creative commons attribution)(?: [1-4] [05])?", "cc by [1-4] [05]", r"creativecommons org licenses by", "c", "creativecommons"),
    ("odbl", r"(?:open database licen[sc]e|odbl)(?: v?1 0)?", "odbl 1 0", r"opendatacommons org licenses odbl", "d", "opendatacommons"),
    ("odc-by", r"open data commons attribution licen[sc]e", "odc by 1 0", r"opendatacommons org licenses by", "commons", "opendatacommons"),
    ("pddl", r"public domain dedication and licen[sc]e", "pddl 1 0", r"opendatacommons org licenses pddl", "domain", "opendatacommons"),
    ("public-domain", r"(?:released|placed|dedicated|is|are) (?:in|into|to) the public domain", "", "", "domain", ""),
    ("proprietary", r"(?:all rights reserved|proprietary and confidential)", "", "", "r", ""),
    ("copyright", r"copyright(?: c)? (?:19|20)[0-9]{2}", "", "", "copyright", ""),
)
_GRANT = (r"(?:licen[sc]ed|released|distributed|available|provided|published|redistributed) under (?:the )?"
          r"(?:terms of (?:the )?)?(?:conditions of (?:the )?)?")
# A text is scanned when it has one of these, or "cc" and "by" with only separators between.
GATE = ("licen", "copyright", "spdx", "gnu", "gpl", "gfdl", "creative", "creativecommons", "cc0", "wtfpl", "odbl", "0bsd", "domain",
        "opensource", "apache", "bsd", "mozilla", "attribution", "rights", "proprietary", "eclipse", "eupl", "boost", "zlib",
        "gnu", "opendatacommons", "github", "scripts")
_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def rules() -> list[tuple[int, str, int, str, str, float]]:
    """Rules in order: number, label, priority (0 is highest), keyword, pattern, weight."""
    listed = [(label, 0, keyword, phrase, 1.0) for label, phrase, keyword in BASE]
    listed += [(x[0], 1, "spdx", f"spdx licen[sc]e identifier {x[2]}", 1.0) for x in LICENSES if x[2]]
    listed += [(x[0], 2, x[5], x[3], 0.9) for x in LICENSES if x[3]]
    listed += [(x[0], 3, "under", _GRANT + x[1], 0.95) for x in LICENSES]
    listed += [(x[0], 4, x[4], x[1], 0.6) for x in LICENSES]
    return [(i, label, priority, keyword, f"(?<= ){pattern}(?= )", weight)
            for i, (label, priority, keyword, pattern, weight) in enumerate(listed)]


def gate(text: Column) -> Column:
    """Whether a text can match any rule."""
    low = F.lower(text)
    passes = low.contains("cc") & low.rlike(f"cc{_SEPARATOR}by")
    for keyword in dict.fromkeys(GATE):
        passes = passes | low.contains(keyword)
    return passes


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def detections(gated: DataFrame) -> DataFrame:
    """All matches of all rules in ``norm``, words with blanks around: ``row``, ``rule``, ``label``, ``priority``,
    ``weight``, ``first``, ``last`` (words), ``kept``.

    A match inside another of a higher priority is suppressed; inside one of its own priority too if that is
    longer, or as long and by an earlier rule.
    """
    table = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(label).alias("label"), F.lit(p).alias("priority"),
                               F.lit(k).alias("keyword"), F.lit(x).alias("pattern"), F.lit(w).alias("weight"))
                      for i, label, p, k, x, w in rules()])
    hits = gated.select("row", "norm", F.explode(F.filter(table, lambda r: F.contains(F.col("norm"), r["keyword"]))).alias("r")) \
        .select("row", "r.rule", "r.label", "r.priority", "r.weight",
                F.split("norm", F.col("r.pattern"), -1).alias("pieces"),
                F.regexp_extract_all("norm", F.col("r.pattern"), F.lit(0)).alias("found")) \
        .where(F.size("found") > 0) \
        .select("row", "rule", "label", "priority", "weight",
                F.posexplode(F.arrays_zip(F.slice("pieces", 1, F.size("found")).alias("piece"), F.col("found"))).alias("k", "m")) \
        .repartition("row")
    so_far = Window.partitionBy("row", "rule").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    spans = hits.withColumn("length", _spaces(F.col("m.found"))) \
        .withColumn("first", (F.sum(_spaces(F.col("m.piece")) + F.col("length")).over(so_far) - F.col("length") - 1).cast("long")) \
        .withColumn("last", F.col("first") + F.col("length")).drop("m", "k", "length")
    earlier = Window.partitionBy("row").orderBy("first", F.desc("last"), "priority", "rule") \
        .rowsBetween(Window.unboundedPreceding, -1)
    reach = F.element_at(F.array(*[F.max(F.when(F.col("priority") <= p, F.col("last"))).over(earlier) for p in range(5)]),
                         F.col("priority") + 1)
    return spans.withColumn("kept", F.coalesce(reach < F.col("last"), F.lit(True)))


def prepare(docs: DataFrame) -> DataFrame:
    """One pass over the texts: ``row``, ``doc_id``, ``n_words``, ``norm`` (null where no rule can match)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    low = lower_ascii(F.col("text").cast("string"))
    counted = F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long")
    words = F.regexp_extract_all(low, F.lit(WORD), F.lit(0))
    return durable(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), counted.alias("n_words"),
        F.when(gate(text), F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))).alias("norm")), "words")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels``, ``score``, ``n_detections``.

    Base columns count the places of the fixed phrases; a text without any has null first and last word and empty labels.
    ``labels`` has those of all detections that are not suppressed, base ones
    always; ``score`` is the highest weight among them, 0 without any. Null and
    empty texts have no words and no labels. Repeated rows are scanned each.
    Other columns are not read. Only texts with a keyword are looked at by rules,
    and each rule only at texts with its own keyword.
    """
    prepared = prepare(docs)
    per_row = detections(prepared.where("norm is not null").select("row", "norm")).groupBy("row").agg(
        F.count(F.when(F.col("priority") == 0, 1)).alias("n_base"),
        F.min(F.when(F.col("priority") == 0, F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("priority") == 0, F.col("first"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("priority") == 0, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("kept"), F.col("label")))), ",").alias("labels"),
        F.max(F.when(F.col("kept"), F.col("weight"))).alias("score"),
        F.count(F.when(F.col("kept"), 1)).alias("n_detections"))
    return prepared.drop("norm").join(per_row, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("n_detections", F.lit(0)).cast("long").alias("n_detections"))
