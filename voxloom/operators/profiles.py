"""Language profiles: fallback chains, inheritance, grapheme to phoneme."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.operators.lineage import cut


def fallback_steps(profiles: DataFrame) -> DataFrame:
    """(profile_id, lang, dialect, step, fallback): a profile's own dialect as step 0, then its chain in order."""
    chain = F.concat(F.array("dialect"), F.coalesce("fallback_chain", F.array().cast("array<string>")))
    return profiles.select("profile_id", "lang", "dialect", F.posexplode(chain).alias("step", "fallback"))


def fallback_cycles(profiles: DataFrame) -> DataFrame:
    """(dialect, length): dialects that come back to themselves over the chains of others, by the shortest way.

    Ways go on until no new place comes out, so at most as many steps as there are dialects.
    """
    edges = profiles.select(F.col("dialect").alias("a"), F.explode("fallback_chain").alias("b")).dropna().distinct()
    fresh = seen = cut(edges.select(F.col("a").alias("dialect"), F.col("b").alias("at"), F.lit(1).alias("length")))
    n = 1
    while not fresh.isEmpty():
        n += 1
        ahead = fresh.where(F.col("dialect") != F.col("at")).join(edges, F.col("at") == F.col("a")).select("dialect", F.col("b").alias("at")).distinct()
        fresh = cut(ahead.join(seen, ["dialect", "at"], "left_anti").withColumn("length", F.lit(n)))
        seen = seen.unionByName(fresh)
    return seen.where(F.col("dialect") == F.col("at")).groupBy("dialect").agg(F.min("length").alias("length"))


def inherited(profiles: DataFrame, columns: list[str], at: str = "updated_at") -> DataFrame:
    """(profile_id, columns): each column from the profile, else from the first profile in its chain that has it.

    Where several profiles have one dialect, the value updated last counts, then the one of the largest profile_id.
    """
    steps = fallback_steps(profiles).select("profile_id", "step", "fallback")
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(F.coalesce(F.unix_micros(F.col(at).cast("timestamp")), F.lit(-(1 << 62))), "profile_id"))).alias(c) for c in columns]
    joined = steps.join(profiles.groupBy(F.col("dialect").alias("fallback")).agg(*last), "fallback", "left")
    return joined.groupBy("profile_id").agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("step"))).alias(c) for c in columns])


#: Stand-ins for what rules have written, one for each of a dialect's rules; letters of no script.
_MARKS = "".join(map(chr, range(0xE000, 0xF900)))
_RULES = "array<struct<core:string,search:string,mark:string,ipa:string>>"


def ordered_rules(rules: DataFrame) -> DataFrame:
    """(lang, dialect, _rules): each dialect's rules in the order they are tried, as a search pattern, a mark and its IPA.

    From high to low priority, then longer patterns first, then by rule_id. ``^`` and ``$`` at a pattern's ends, and the condition
    position (initial, medial, final), tie it to the word's ends; before and after name the letters that must follow or precede.
    Rules without pattern or IPA are left out. A dialect has at most 6,400 rules, or an error is raised.
    """
    quoted = lambda c: F.concat(F.lit("\\Q"), c, F.lit("\\E"))
    condition = lambda k: F.try_element_at("conditions", F.lit(k))
    core = F.regexp_replace("pattern", r"^\^|\$$", "")
    place = F.coalesce(condition("position"), F.lit(""))
    first, last = F.col("pattern").startswith("^") | (place == "initial"), F.col("pattern").endswith("$") | (place == "final")
    search = F.concat(
        F.when(first, "^").when(place == "medial", "(?<=.)").otherwise(""),
        F.when(condition("after").isNotNull(), F.concat(F.lit("(?<="), quoted(condition("after")), F.lit(")"))).otherwise(""),
        quoted(core),
        F.when(condition("before").isNotNull(), F.concat(F.lit("(?="), quoted(condition("before")), F.lit(")"))).otherwise(""),
        F.when(last, "$").when(place == "medial", "(?=.)").otherwise(""),
    )
    good = rules.where("pattern IS NOT NULL AND ipa IS NOT NULL AND dialect IS NOT NULL").select("*", core.alias("_core"), search.alias("_search")).where("_core <> ''")
    key = F.struct((-F.coalesce("priority", F.lit(0))).alias("p"), (-F.length("_core")).alias("l"), "rule_id", F.col("_core").alias("core"), F.col("_search").alias("search"), "ipa")
    per = good.groupBy("lang", "dialect").agg(F.array_sort(F.collect_list(key)).alias("r"))
    few = F.when(F.size("r") > len(_MARKS), F.raise_error(F.lit("too many rules in one dialect")).cast("boolean")).otherwise(F.lit(True))
    marked = F.transform("r", lambda r, i: F.struct(r["core"].alias("core"), r["search"].alias("search"), F.substring(F.lit(_MARKS), i + 1, F.lit(1)).alias("mark"), r["ipa"].alias("ipa")))
    return per.where(few).select("lang", "dialect", marked.alias("_rules"))


def apply_rules(words: DataFrame, rules: DataFrame) -> DataFrame:
    """``words`` (lang, dialect, word) with the IPA that the dialect's rules make of them in ``rule_ipa``; null where none applies.

    A rule replaces its matches by a mark that no other rule can match, so IPA is never read as letters; marks become IPA at
    the end. Letters that no rule takes stay. Conditions look at letters that aren't replaced yet.
    """
    joined = words.join(F.broadcast(ordered_rules(rules)), ["lang", "dialect"], "left")  # one row per dialect
    given = F.coalesce("_rules", F.array().cast(_RULES))
    step = lambda acc, r: F.when(acc.contains(r["core"]), F.regexp_replace(acc, r["search"], r["mark"])).otherwise(acc)
    marked = joined.withColumn("_marked", F.aggregate(given, F.col("word"), step))
    spoken = F.aggregate(given, F.col("_marked"), lambda acc, r: F.replace(acc, r["mark"], r["ipa"]))
    return marked.withColumn("rule_ipa", F.when(F.col("_marked") != F.col("word"), spoken)).drop("_rules", "_marked")


def resolve_pronunciations(words: DataFrame, overrides: DataFrame, rules: DataFrame, profiles: DataFrame) -> DataFrame:
    """(lang, dialect, word, ipa, by, step): override, then rule, then the same along the dialect's fallback chain.

    Step 0 is the dialect itself: its override, else one without dialect, else its rules if any applies to the word; then the
    first dialect of its chain, and so on. Of several overrides the one updated last counts, then the largest override_id.
    ``by`` is override, rule or none (null IPA and step). A null dialect has overrides without dialect alone.
    """
    asked = words.select("lang", "dialect", "word").where("lang IS NOT NULL AND word IS NOT NULL").distinct()
    chains = fallback_steps(profiles).where("step > 0").groupBy("lang", "dialect", "fallback").agg(F.min("step").alias("step")).where("fallback <> dialect")
    own = asked.select("*", F.col("dialect").alias("fallback"), F.lit(0).alias("step"))
    asked_at = own.unionByName(asked.join(F.broadcast(chains), ["lang", "dialect"]).select(*own.columns))
    last = overrides.where("ipa IS NOT NULL").groupBy("lang", "dialect", "word").agg(F.max(F.struct("updated_at", "override_id", "ipa")).alias("_o"))
    last = last.select("lang", "dialect", "word", F.col("_o.ipa").alias("ipa"))
    found = lambda df, step, rank, by: df.select("lang", "dialect", "word", F.struct(F.lit(rank).alias("rank"), step.alias("step"), "ipa", F.lit(by).alias("by")).alias("f"))
    named = asked_at.where("fallback IS NOT NULL").join(last.withColumnRenamed("dialect", "fallback"), ["lang", "fallback", "word"])
    anyone = asked.join(last.where("dialect IS NULL").drop("dialect"), ["lang", "word"])
    made = asked_at.where("fallback IS NOT NULL").select("lang", F.col("fallback").alias("dialect"), "word").distinct()
    ruled = apply_rules(made, rules).where("rule_ipa IS NOT NULL").select("lang", F.col("dialect").alias("fallback"), "word", F.col("rule_ipa").alias("ipa"))
    ruled = asked_at.join(ruled, ["lang", "fallback", "word"])
    nothing = asked.select("*", F.lit(None).cast("string").alias("ipa"))
    all_ = found(named, F.col("step"), 0, "override").unionByName(found(anyone, F.lit(0), 1, "override")).unionByName(found(ruled, F.col("step"), 2, "rule"))
    all_ = all_.unionByName(found(nothing, F.lit(1 << 20), 9, "none"))
    best = all_.groupBy("lang", "dialect", "word").agg(F.min_by("f", F.struct("f.step", "f.rank")).alias("f"))
    return best.select("lang", "dialect", "word", "f.ipa", "f.by", F.when(F.col("f.by") != "none", F.col("f.step")).alias("step"))
