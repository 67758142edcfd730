"""Values that results must share with the wiki's own conventions (fixed values)."""

#: Pages of the site's own interface that every page links to; they are no subjects.
CHROME_TITLES = ("편집 요청", "크리에이티브 커먼즈 라이선스")
#: Namespaces whose pages are no articles.
NAMESPACES = ("분류:", "틀:", "파일:", "사용자:", "나무위키:", "휴지통:", "투표:", "토론:", "위키운영:", "템플릿:")
#: Titles of years, months and days, without and with days of the week.
CALENDAR = r"^(\d{1,4}년(대)?|\d{1,2}월( \d{1,2}일)?)$"
CALENDAR_WEEK = r"^(\d{1,4}년(대)?|\d{1,2}월( \d{1,2}일)?|[월화수목금토일]요일)$"
#: Predicates that only hold for persons.
PERSON_PREDICATES = ("출생", "사망", "학력", "배우자", "부모", "자녀", "형제", "가족", "직업")
#: In-links from which a page has a crawl priority, and the priority of pages without any.
TIERS = ((50, 40), (20, 60), (5, 90), (2, 130), (1, 180))
FLOOR = 220
#: How categories begin that are no types but notes of the site, and a word of its navigation.
CATEGORY_NOISE = ("※", "나무위키", "문서가 ", "토론", "편집")
NAVIGATION = "둘러보기"
