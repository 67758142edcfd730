"""Typed relations and entity classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.pages import PREDICATES, facts, per_page
from ..functions.text import head_noun, parent_title
from ..functions.values import CALENDAR, CATEGORY_NOISE, NAVIGATION

KEY = ["subject", "predicate", "object", "source"]
#: How the corpus tables name the seven classes.
CLASSES = {"인물": "person", "장소": "place", "조직": "organization", "작품": "work", "사건": "event", "생물": "creature", "개념": "concept"}
#: Predicates that settle a class, and the order in which classes are tried (fixed values).
BY_PREDICATE = {
    "장소": ("수도", "소재지", "정치체제", "통화"),
    "인물": ("출생", "사망", "학력", "배우자", "부모", "자녀", "형제", "국적", "직업"),
    "조직": ("설립자", "창립자", "본사", "회장", "대표", "상위 조직", "산하"),
    "작품": ("제작사", "배급사", "주연", "출연", "원작"),
}
#: Head nouns of categories that vote for a class, in the order that settles ties (fixed values).
BY_CATEGORY = {
    "사건": ("사건", "사고", "사건사고", "범죄", "전쟁", "참사", "테러", "재판"),
    "생물": ("동물", "식물", "곤충", "어류", "조류", "포유류", "생물"),
    "장소": ("국가", "개최국", "도시", "개최도시", "지역", "행정구역", "자치단체", "특별시", "광역시", "수도", "소재지", "지명", "산", "강", "섬", "역", "공항", "건축물", "도로"),
    "조직": ("정당", "기업", "설립", "학교", "대학교", "구단", "축구단", "창단", "회사", "단체", "방송국", "정부", "부대", "협회", "연맹"),
    "작품": ("영화", "드라마", "게임", "애니메이션", "소설", "만화", "앨범", "노래", "프로그램", "웹툰", "뮤지컬"),
    "인물": ("인물", "출생", "출신", "사망", "데뷔", "은퇴", "정치인", "선수", "국회의원", "메달리스트", "감독", "배우", "가수", "작가", "군인"),
}
#: Categories that are a page's own, from the front; shortest word that may end a longer head noun.
OWN, SHORTEST_SUFFIX = 6, 3


def _triples(df: DataFrame, subject: str, predicate: Column, object: str, kind: str, source: str, evidence: Column | None = None) -> DataFrame:
    return df.select(
        F.col(subject).alias("subject"), predicate.alias("predicate"), F.col(object).alias("object"), F.lit(kind).alias("obj_kind"), F.lit(source).alias("source"),
        (F.lit(None).cast("string") if evidence is None else evidence).alias("evidence"),
    )


def title_relations(pages: DataFrame) -> DataFrame:
    """PART_OF the page one level up, from titles with a slash."""
    up = pages.select("title", parent_title(F.col("title")).alias("parent")).where("parent IS NOT NULL")
    return _triples(up, "title", F.lit("PART_OF"), "parent", "page", "title", F.col("title"))


def clean_category(category: Column) -> Column:
    noise = category.contains(NAVIGATION)
    for prefix in CATEGORY_NOISE:
        noise = noise | category.startswith(prefix)
    return (category != "") & ~noise


def category_relations(pages: DataFrame) -> DataFrame:
    """INSTANCE_OF each clean category."""
    each = pages.select("title", F.explode("categories").alias("category")).where(clean_category(F.col("category")))
    return _triples(each, "title", F.lit("INSTANCE_OF"), "category", "literal", "category")


def redirect_relations(redirects: DataFrame) -> DataFrame:
    """SAME_AS the canonical page."""
    return _triples(redirects.where("alias IS NOT NULL AND canonical IS NOT NULL"), "alias", F.lit("SAME_AS"), "canonical", "page", "redirect")


def infobox_relations(pages: DataFrame, html: str, *, any_label: bool = False) -> DataFrame:
    """Facts of each page's infobox; pages: doc_id, title and the page's HTML."""
    labels = None if any_label else PREDICATES
    found = per_page(pages, "doc_id", html, lambda s: facts(s, labels), "predicate string, object string, obj_kind string, evidence string")
    return found.join(pages.select("doc_id", F.col("title").alias("subject")), "doc_id").select("subject", "predicate", "object", "obj_kind", F.lit("infobox").alias("source"), "evidence")


def build(*parts: DataFrame) -> DataFrame:
    """All relations, one of each key; of several the one with the least kind and evidence."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(*KEY).agg(F.min(F.struct("obj_kind", "evidence")).alias("x")).select("subject", "predicate", "object", "x.obj_kind", "source", "x.evidence")


def entity_class(title: Column, categories: Column, predicates: Column) -> Column:
    """The class of a page, in built-in expressions alone.

    Calendar titles are concepts. Else a predicate settles it. Else each of the first OWN categories votes
    by its head noun (whole, or ending in a longer word), but for those of another namespace and those
    that contain the title; most votes win, ties by order. Else a concept.
    """
    out = F.when(title.rlike(CALENDAR), F.lit(CLASSES["개념"]))
    held = F.coalesce(predicates, F.array().cast("array<string>"))
    for name, keys in BY_PREDICATE.items():
        out = out.when(F.arrays_overlap(held, F.array(*map(F.lit, keys))), F.lit(CLASSES[name]))
    own = F.filter(
        F.slice(F.coalesce(categories, F.array().cast("array<string>")), 1, OWN),
        lambda c: c.isNotNull() & ~c.startswith("분류:") & ~(F.coalesce(title != "", F.lit(False)) & (title != c) & c.contains(title)),
    )
    heads = F.transform(own, head_noun)

    def votes(keys: tuple[str, ...]) -> Column:
        def hit(word: Column) -> Column:
            test = word.isin(*keys)
            for key in keys:
                if len(key) >= SHORTEST_SUFFIX:
                    test = test | word.endswith(key)
            return test

        return F.size(F.filter(heads, hit))

    order = list(BY_CATEGORY)
    scores = [F.struct(votes(BY_CATEGORY[name]).alias("n"), F.lit(len(order) - k).alias("o"), F.lit(CLASSES[name]).alias("c")) for k, name in enumerate(order)]
    best = F.array_max(F.array(*scores))
    return out.when(best["n"] > 0, best["c"]).otherwise(F.lit(CLASSES["개념"]))
