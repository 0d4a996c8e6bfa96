"""Sources, category units, display labels, lexicon, screening rules.

The tables below are data that results depend on. They are stated as text in
natural order; everything that uses them takes them as a parameter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Source:
    key: str
    board_id: int
    name: str
    kind: str
    fixed_unit: str | None = None


# Supported boards.
SOURCES: tuple[Source, ...] = (
    Source("warrior", 2294, "전사", "job"),
    Source("magician", 2295, "마법사", "job"),
    Source("archer", 2296, "궁수", "job"),
    Source("thief", 2297, "도적", "job"),
    Source("pirate", 2298, "해적", "job"),
    Source("free", 5974, "자유 게시판", "free", "free"),
    Source("qna", 2300, "질문과 답변", "info", "qna"),
    Source("tips", 2304, "팁과 노하우", "info", "tips"),
)

# Board category -> analysis unit.
CATEGORY_UNITS: dict[int, dict[str, str]] = {
    2294: {
        "히어로": "hero",
        "팔라딘": "paladin",
        "다크나이트": "dark_knight",
        "소울마스터": "soul_master",
        "아란": "aran",
        "데몬슬레이어": "demon_slayer",
        "미하일": "mihile",
        "카이저": "kaiser",
        "데몬어벤져": "demon_avenger",
        "제로": "zero",
        "블래스터": "blaster",
        "아델": "adele",
        "렌": "len",
        "기타": "warrior_other",
    },
    2295: {
        "아크(불독)": "arch_mage_fire_poison",
        "아크(썬콜)": "arch_mage_ice_lightning",
        "비숍": "bishop",
        "플레임위자드": "flame_wizard",
        "에반": "evan",
        "배틀메이지": "battle_mage",
        "루미너스": "luminous",
        "키네시스": "kinesis",
        "일리움": "illium",
        "라라": "lara",
        "레테": "lete",
        "기타": "magician_other",
    },
    2296: {
        "보우마스터": "bowmaster",
        "신궁": "marksman",
        "윈드브레이커": "wind_archer",
        "와일드헌터": "wild_hunter",
        "메르세데스": "mercedes",
        "패스파인더": "pathfinder",
        "카인": "kain",
        "기타": "archer_other",
    },
    2297: {
        "나이트로드": "night_lord",
        "섀도어": "shadower",
        "나이트워커": "night_walker",
        "듀얼블레이드": "dual_blade",
        "괴도팬텀": "phantom",
        "카데나": "cadena",
        "호영": "hoyoung",
        "칼리": "khali",
        "기타": "thief_other",
    },
    2298: {
        "메카닉": "mechanic",
        "바이퍼": "buccaneer",
        "캡틴": "corsair",
        "스트라이커": "thunder_breaker",
        "캐논슈터": "cannon_shooter",
        "엔젤릭버스터": "angelic_buster",
        "제논": "xenon",
        "은월": "shade",
        "아크": "ark",
        "기타": "pirate_other",
    },
}

# Units that are not jobs, and the suffix of catch-all units.
GENERAL_UNITS: tuple[str, ...] = ("free", "qna", "tips")
OTHER_SUFFIX = "_other"

# Engagement counters, in display order.
METRICS: tuple[str, ...] = ("views", "recommendations", "comments")

# Counters in the order that decides a selection reason.
SELECTION_ORDER: tuple[str, ...] = ("comments", "recommendations", "views")

# Display labels.
SENTIMENT_LABELS = {"positive": "긍정", "neutral": "중립", "negative": "부정", "mixed": "혼합"}
INTENT_LABELS = {
    "complaint": "불만",
    "request": "요구",
    "debate": "토론",
    "question": "질문",
    "praise": "칭찬",
    "information": "정보",
}
REASON_LABELS = {"comments": "댓글 상위", "recommendations": "추천 상위", "views": "조회 상위"}
NO_EVIDENCE_LABEL = "직접 표현 없음"
SPARSE_SUFFIX = " 표본 부족"

# Row markers on list pages.
NOTICE_CLASSES: tuple[str, ...] = ("notice", "notice-row")
AD_CLASSES: tuple[str, ...] = ("ad", "ad-row", "advertisement")
NOTICE_LABEL = "공지"
AD_LABEL = "광고"


@dataclass(frozen=True)
class Lexicon:
    """Versioned term lists. Group order matters: earlier groups win ties."""

    version: str
    positive: tuple[str, ...]
    negative: tuple[str, ...]
    intents: tuple[tuple[str, tuple[str, ...]], ...]
    topics: tuple[tuple[str, tuple[str, ...]], ...]
    default_intent: str = "information"
    default_topic: str = "커뮤니티"


# Domain lexicon.
DOMAIN_LEXICON = Lexicon(
    version="domain-lexicon-v1.1",
    positive=(
        "좋다", "좋아요", "기대", "만족", "개선됐다", "편하다", "재미", "최고", "감사", "이쁘다",
        "예쁘다",
    ),
    negative=(
        "나쁘다", "최악", "불편", "오류", "버그", "문제", "답답", "부족", "너프", "하향", "싫다",
        "아쉽", "화난다", "심각",
    ),
    intents=(
        ("request", ("개선", "필요", "해주세요", "해 주세요", "바꿔", "추가", "요구", "원한다", "부탁")),
        ("complaint", ("불편", "최악", "문제", "오류", "버그", "답답", "왜", "아쉽")),
        ("debate", ("어떻게 생각", "의견", "토론", "맞나", "아닌가", "비교")),
        ("question", ("궁금", "질문", "알려", "인가요", "하나요", "되나요", "어떻게")),
        ("praise", ("좋다", "좋아요", "최고", "감사", "만족", "기대")),
        ("information", ("정리", "공략", "정보", "안내", "패치", "업데이트", "요약")),
    ),
    topics=(
        ("밸런스·스킬", ("밸런스", "스킬", "딜", "데미지", "쿨타임", "코어", "직업")),
        ("버그·사용성", ("버그", "오류", "불편", "UI", "입력", "렉", "튕김")),
        ("성장·보상", ("성장", "보상", "경험치", "레벨", "재화", "에르다")),
        ("보스·전투", ("보스", "전투", "사냥", "바인드", "패턴", "극딜")),
        ("경제·옥션", ("옥션", "경매장", "메소", "가격", "거래", "시세")),
        ("이벤트·캐시", ("이벤트", "캐시", "로얄", "부티크", "쿠폰", "코디")),
        ("운영·소통", ("운영", "공지", "소통", "라이브", "사과", "문의")),
        ("커뮤니티", ("유저", "커뮤니티", "길드", "파티", "인벤")),
    ),
)


@dataclass(frozen=True)
class SelectionPolicy:
    version: str
    window_days: int
    job_per_metric: int
    general_per_metric: int


# Sampling policy for text labelling.
SELECTION_POLICY = SelectionPolicy("engagement-top-v2", 90, 5, 20)


@dataclass(frozen=True)
class ScanRule:
    """One screening pattern.

    ``anchors`` are plain substrings of which every match contains at least one;
    they let Spark skip clean text without calling Python. Leave them empty when
    no such set exists and every text will be searched.
    """

    rule_id: str
    score: int
    pattern: str
    anchors: tuple[str, ...] = ()


INVISIBLE_RULE_ID = "text.invisible-control"
INVISIBLE_SCORE = 30

# Prompt screening patterns (matched ignoring case).
PROMPT_RULES: tuple[ScanRule, ...] = (
    ScanRule(
        "prompt.instruction-override",
        70,
        r"(?:\b(?:ignore|disregard|forget|override)\b[^,.;:!?-]{0,50}?"
        r"\b(?:previous|prior|above|earlier|system)\b[^,.;:!?-]{0,30}?"
        r"\b(?:instructions?|prompts?|commands?)\b)"
        r"|(?:(?<!\w)(?:앞선|이전|위의|기존)(?!\w)[^,.;:!?-]{0,30}?"
        r"(?<!\w)(?:명령|지시|프롬프트)(?:을|를)?(?!\w)[^,.;:!?-]{0,20}?"
        r"(?<!\w)(?:무시(?!무시)|따르지|재정의|덮어쓰))",
        ("ignore", "disregard", "forget", "override", "무시", "따르지", "재정의", "덮어쓰"),
    ),
    ScanRule(
        "prompt.secret-or-environment-request",
        70,
        r"(?:\b(?:print|show|read|reveal|expose|modify|change|edit|set|dump)\b"
        r"[\s\S]{0,60}?(?:\.env\b|\bapi[\s_-]*key\b|\benvironment\s+variables?\b|"
        r"\bsecrets?\b|\baccess[\s_-]*tokens?\b|\bpasswords?\b))"
        r"|(?:(?:\.env\b|\bapi[\s_-]*key\b|\benvironment\s+variables?\b|"
        r"\bsecrets?\b|\baccess[\s_-]*tokens?\b|\bpasswords?\b)"
        r"[\s\S]{0,60}?\b(?:print|show|read|reveal|expose|modify|change|edit|set|dump)\b)"
        r"|(?:(?:출력|보여|읽|공개|수정|변경|설정|접근|내놔)"
        r"[\s\S]{0,40}?(?:환경\s*변수|비밀|API[\s_-]*키|접근\s*토큰|비밀번호))"
        r"|(?:(?:환경\s*변수|비밀|API[\s_-]*키|접근\s*토큰|비밀번호)"
        r"[\s\S]{0,40}?(?:출력|보여|읽|공개|수정|변경|설정|접근|내놔))",
        (".env", "api", "environment", "secret", "token", "password", "환경", "비밀", "토큰"),
    ),
    ScanRule(
        "prompt.tool-or-shell-request",
        60,
        r"(?:\b(?:run|execute|launch|invoke|open|use)\b[\s\S]{0,60}?"
        r"\b(?:shell|bash|powershell|cmd|terminal|command)\b)"
        r"|(?:\b(?:shell|bash|powershell|cmd|terminal|command)\b[\s\S]{0,60}?"
        r"\b(?:run|execute|launch|invoke|open|use)\b)"
        r"|(?:(?:셸|쉘|터미널|명령어|파워셸|파워쉘|bash|powershell|cmd)"
        r"[\s\S]{0,40}?(?:실행|열어|사용|호출))"
        r"|(?:(?:실행|열어|사용|호출)[\s\S]{0,40}?"
        r"(?:셸|쉘|터미널|명령어|파워셸|파워쉘|bash|powershell|cmd))",
        ("shell", "bash", "cmd", "terminal", "command", "셸", "쉘", "터미널", "명령어"),
    ),
    ScanRule(
        "prompt.system-impersonation",
        60,
        r"(?:<\s*(?:/\s*)?system(?:\s|>)|\[\s*system\s*\]|\bsystem\s+(?:prompt|message|role)\b|"
        r"\byou\s+are\s+now\s+(?:the\s+)?(?:system|developer)\b|"
        r"<\s*(?:/\s*)?시스템(?:\s|>)|\[\s*시스템\s*\]|시스템\s*(?:프롬프트|메시지|역할))",
        ("system", "developer", "시스템"),
    ),
)


def boards_frame(spark: SparkSession, sources: tuple[Source, ...] = SOURCES) -> DataFrame:
    """Board dimension ``(id, name, kind)``; one row per registered source."""
    return spark.createDataFrame(
        [(s.board_id, s.name, s.kind) for s in sources], "id INT, name STRING, kind STRING"
    )


def unit_map_frame(
    spark: SparkSession,
    sources: tuple[Source, ...] = SOURCES,
    categories: dict[int, dict[str, str]] = CATEGORY_UNITS,
) -> DataFrame:
    """Unit dimension ``(board_id, category, unit)``; ``category`` is null for fixed units."""
    rows = []
    for source in sources:
        if source.kind == "job":
            rows += [(source.board_id, c, u) for c, u in categories.get(source.board_id, {}).items()]
        else:
            rows.append((source.board_id, None, source.fixed_unit))
    return spark.createDataFrame(rows, "board_id INT, category STRING, unit STRING")


def job_label_frame(
    spark: SparkSession, categories: dict[int, dict[str, str]] = CATEGORY_UNITS
) -> DataFrame:
    """Display names ``(analysis_unit, job)`` of every unit that is a real job."""
    rows = [
        (unit, label)
        for units in categories.values()
        for label, unit in units.items()
        if not unit.endswith(OTHER_SUFFIX)
    ]
    return spark.createDataFrame(rows, "analysis_unit STRING, job STRING")
