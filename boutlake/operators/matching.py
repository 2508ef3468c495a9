"""Fuzzy matching of athletes and teams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boutlake.functions.compat import b2i, last_of, soundex_full
from boutlake.operators.ordered import with_neighbours

#: Characters of the piece by which texts that hold one another meet.
PIECE = 3


def clean_team(team: Column) -> Column:
    """Lower case first, then anything but letters, digits and spaces becomes a space; ends are trimmed."""
    return F.trim(F.regexp_replace(F.lower(team), "[^0-9a-z ]", " "))


def norm_name(c: Column) -> Column:
    """Letters, digits and single spaces in lower case; anything else counts as a space."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9 ]", " "), r"\s+", " ")))


def _pieces(text: Column, size: int) -> Column:
    """Distinct pieces of one size."""
    all_ = F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substr(text, i, F.lit(size)))
    return F.when(F.length(text) >= size, F.array_distinct(all_)).otherwise(F.array().cast("array<string>"))


def _held(holders: DataFrame, held: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs of distinct texts where a holds b, ignoring case.

    b meets the texts that hold its rarest piece of PIECE characters (all of b if shorter), by an equi-join;
    the whole of b is tested after that. Null and empty texts hold and meet nothing.
    """
    low_a, low_b = F.lower(a), F.lower(b)
    sizes = F.concat(*(_pieces(low_a, n) for n in range(1, PIECE + 1)))
    x = holders.select(a).where(F.col(a) != "").distinct().select(a, F.explode(sizes).alias("piece"))
    y = held.select(b).where(F.col(b) != "").distinct()
    y = y.select(b, F.explode(F.when(F.length(low_b) < PIECE, F.array(low_b)).otherwise(_pieces(low_b, PIECE))).alias("piece"))
    seen = x.groupBy("piece").agg(F.count("*").alias("n"))
    rarest = y.join(seen, "piece", "left").groupBy(b).agg(F.min_by("piece", F.struct(F.coalesce("n", F.lit(0)), "piece")).alias("piece"))
    return x.join(rarest, "piece").where(low_a.contains(low_b)).select(a, b)


def theta_pairs(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Distinct values of two columns that hold one another. Callers join back on equality."""
    one = _held(left, right, left_on, right_on)
    return one.unionByName(_held(right, left, right_on, left_on)).distinct()


def best_candidates(names: DataFrame, candidates: DataFrame, least: int = 4, same_weight: bool = False) -> DataFrame:
    """names (list_id, name, school) × candidates (candidate, other) → the best candidate of each name, and its score.

    Schools must hold one another; the part of a list's school before a comma counts. The last word of the
    name must be within the candidate, or both must sound alike. A point each: the first word is within the
    candidate, the last word is, both sound alike, either school holds the other (two if they are equal).
    Weight plays no part, for athletes change it, unless same_weight asks that a column weight of both be equal. Ties go to the least candidate, then school. Names without a
    match of least points are left out, as are null and blank names and schools.

    Distinct names meet distinct candidates by equality: of related schools and sound, and of related schools
    and a last word that the candidate holds.
    """
    a = names.withColumns({"name_norm": norm_name(F.col("name")), "school_norm": norm_name(F.substring_index("school", ",", 1))}).where("name_norm <> ''")
    weight = ["weight"] if same_weight else []
    people = a.select("name_norm", "school_norm", *weight).distinct().withColumns({"last": last_of(F.col("name_norm"), " "), "sound": soundex_full("name_norm")})
    b = candidates.select("candidate", "other", norm_name(F.col("candidate")).alias("c_norm"), norm_name(F.col("other")).alias("other_norm"), *weight).distinct()
    schools = theta_pairs(people, b, "school_norm", "other_norm")
    # Schools and sounds, schools and last words meet before names do: there are far fewer of them.
    of_sound = people.select("school_norm", "sound", *weight).distinct().join(schools, "school_norm")
    by_sound = people.join(of_sound.join(b.withColumn("sound", soundex_full("c_norm")), ["other_norm", "sound", *weight]), ["school_norm", "sound", *weight])
    of_last = people.select("school_norm", "last", *weight).distinct().join(schools, "school_norm")
    by_last = people.join(of_last.join(b.join(_held(b, people, "c_norm", "last"), "c_norm"), ["other_norm", "last", *weight]), ["school_norm", "last", *weight])
    columns = ["name_norm", "school_norm", *weight, "last", "candidate", "other", "c_norm", "other_norm"]
    pairs = by_sound.select(columns).unionByName(by_last.select(columns))
    points = [
        F.col("c_norm").contains(F.substring_index("name_norm", " ", 1)), F.col("c_norm").contains(F.col("last")), soundex_full("name_norm") == soundex_full("c_norm"),
        F.col("other_norm").contains(F.col("school_norm")), F.col("school_norm").contains(F.col("other_norm")),
    ]
    pairs = pairs.withColumn("score", sum((b2i(x) for x in points), F.lit(0))).where(F.col("score") >= least)
    best = pairs.groupBy("name_norm", "school_norm", *weight).agg(F.min(F.struct((-F.col("score")).alias("s"), "candidate", "other")).alias("best"))
    return a.join(best, ["name_norm", "school_norm", *weight]).select("list_id", "name", "best.candidate", (-F.col("best.s")).alias("score"))


def name_fixes(found: DataFrame, manual: DataFrame | None = None) -> DataFrame:
    """found (to_name, from_name) and manual pairs → pairs to apply, blanks and no-ops left out, each once.

    Where one name has several replacements, a found one goes before a manual one, then the least counts.
    """
    pairs = found.select(F.trim("to_name").alias("to_name"), F.trim("from_name").alias("from_name"), F.lit(0).alias("rank"))
    if manual is not None:
        pairs = pairs.unionByName(manual.select(F.trim("to_name").alias("to_name"), F.trim("from_name").alias("from_name"), F.lit(1).alias("rank")))
    pairs = pairs.where("to_name <> '' AND from_name <> '' AND to_name <> from_name")
    return pairs.groupBy("from_name").agg(F.min_by("to_name", F.struct("rank", "to_name")).alias("to_name"))


def school_candidates(schools: DataFrame, teams: DataFrame) -> DataFrame:
    """schools (school), teams (team) → each school, its teams in order, how many. Schools without one stay, with 0.

    A team's name before its comma and the school hold one another.
    """
    s = schools.select("school", norm_name(F.col("school")).alias("school_norm")).distinct()
    t = teams.select("team", norm_name(F.substring_index("team", ",", 1)).alias("team_norm")).distinct()
    pairs = theta_pairs(s, t, "school_norm", "team_norm").join(t, "team_norm")
    found = s.join(pairs, "school_norm", "left").groupBy("school")
    return found.agg(F.array_join(F.array_sort(F.collect_set("team")), " , ").alias("teams"), F.count_distinct("team").alias("n_teams"))


def school_fixes(schools: DataFrame, teams: DataFrame, manual: DataFrame | None = None) -> DataFrame:
    """Schools with exactly one team, and manual pairs, as pairs to apply; the team's name counts up to its comma."""
    found = school_candidates(schools, teams).where("n_teams = 1").select(F.col("teams").alias("to_name"), F.col("school").alias("from_name"))
    return name_fixes(found, manual).withColumn("to_name", F.substring_index("to_name", ",", 1))


def _within(clean: Column, other: Column) -> Column:
    """Whether another clean name holds the first and the last word of this one."""
    return other.contains(F.substring_index(clean, " ", 1)) & other.contains(F.substring_index(clean, " ", -1))


def team_neighbours(teams: DataFrame) -> DataFrame:
    """teams (team) → clean name with the names before and after it in order, and whether these hold its first and last word."""
    t = teams.select("team", clean_team(F.col("team")).alias("team_clean")).where("team IS NOT NULL").distinct()
    t = with_neighbours(t, ["team_clean", "team"], {"team_clean": ("before", "after")})
    return t.withColumns({f"like_{c}": b2i(_within(F.col("team_clean"), F.col(c))) for c in ("before", "after")})


def common_prefix(a: Column, b: Column) -> Column:
    """How many characters two texts share from the start."""
    n = F.least(F.length(a), F.length(b))
    sizes = F.filter(F.sequence(F.lit(0), n), lambda i: F.substr(a, F.lit(1), i) == F.substr(b, F.lit(1), i))
    return F.when(a.isNotNull() & b.isNotNull(), F.array_max(sizes))


def alias_pairs(teams: DataFrame, seasons: tuple[str, str]) -> DataFrame:
    """teams (season, team) → pairs of a name of the first season (team_raw) and one of the second (team_canonical).

    A name of one season alone meets the names before and after it in the order of all clean names. A pair
    is proposed where such a neighbour holds the name's first and last word and is of the other season alone;
    the name of either season is then the name itself, else the one before, else the one after, of those
    that are like it and of that season. Names that are empty once cleaned are like any neighbour.
    """
    seen = teams.where("team IS NOT NULL").groupBy("team").agg(*(F.max(b2i(F.col("season") == s)).alias(f"in_{i}") for i, s in enumerate(seasons)))
    seen = seen.withColumn("clean", clean_team(F.col("team")))
    sides = ("prev", "next")
    t = with_neighbours(seen, ["clean", "team"], {c: tuple(f"{s}_{c}" for s in sides) for c in ("team", "clean", "in_0", "in_1")})
    t = t.where("in_0 + in_1 = 1").withColumns({f"like_{s}": F.coalesce(_within(F.col("clean"), F.col(f"{s}_clean")), F.lit(False)) for s in sides})
    other = [F.col(f"like_{s}") & (F.col(f"{s}_in_0") + F.col(f"{s}_in_1") == 1) & (F.col(f"{s}_in_0") != F.col("in_0")) for s in sides]

    def named(i: int) -> Column:
        near = (F.when(F.col(f"like_{s}") & (F.col(f"{s}_in_{i}") == 1), F.col(f"{s}_team")) for s in sides)
        return F.coalesce(F.when(F.col(f"in_{i}") == 1, F.col("team")), *near)

    pairs = t.where(other[0] | other[1]).select(named(0).alias("team_raw"), named(1).alias("team_canonical"))
    return pairs.where("team_raw IS NOT NULL AND team_canonical IS NOT NULL").distinct()


def latest_rankings(athletes: DataFrame, rankings: DataFrame) -> DataFrame:
    """athletes (name, team, …), each row with its ranking: rankings (ranked_name, ranked_school, week, rank, weight, source_file).

    Names are equal but for case, and the school equals the team's name before its comma but for case. Of several
    weeks the latest counts, then the better rank; a missing source, rank or weight is taken from the week
    before. is_name_match is 0 or 1, is_team_match null where no name matches. Every row of athletes stays, equal ones too.
    """
    def latest(column: str) -> Column:
        return F.max_by(column, F.when(F.col(column).isNotNull(), F.struct("week", -F.col("rank"), "weight", "source_file")))

    best = rankings.groupBy(F.lower("ranked_name").alias("__name"), F.lower("ranked_school").alias("__school")).agg(
        F.max_by("ranked_name", F.struct("week", -F.col("rank"), "ranked_name")).alias("ranked_name"),
        F.max_by("ranked_school", F.struct("week", -F.col("rank"), "ranked_school")).alias("ranked_school"),
        F.max("week").alias("week"), *(latest(c).alias(c) for c in ("rank", "weight", "source_file")))
    rows = athletes.join(best, (F.lower("name") == F.col("__name")) & (F.lower(F.substring_index("team", ",", 1)) == F.col("__school")), "left")
    matched = b2i(F.col("__name").isNotNull())
    flags = {"is_name_match": matched, "is_team_match": F.when(matched == 1, 1)}
    return rows.withColumns(flags).select(*athletes.columns, *flags, "ranked_name", "ranked_school", "week", "rank", "weight", "source_file")


def name_difference(name: Column, candidate: Column) -> Column:
    """Where two normed names part: "first=OK | last:lee→lea"."""
    def part(label: str, i: int) -> Column:
        a, b = F.substring_index(name, " ", i), F.substring_index(candidate, " ", i)
        return F.when(a == b, f"{label}=OK").otherwise(F.concat(F.lit(f"{label}:"), a, F.lit("→"), b))

    return F.concat(part("first", 1), F.lit(" | "), part("last", -1))


def last_name_overlap(name: Column, candidate: Column) -> Column:
    """Characters of a last name from where the candidate's last name begins in it; 0 if it is not there."""
    a, b = F.substring_index(name, " ", -1), F.substring_index(candidate, " ", -1)
    at = F.instr(a, b)
    return F.when(at > 0, F.length(a) - at + 1).otherwise(F.when(at == 0, 0))
