"""Fixed values of the filing domain.

Every list in this module is data, not logic: results are only right when these strings and numbers are
exactly as given. They are kept together, in natural order.
"""

# --- fixed values: report classes, in order of priority, with the title fragments that name them ---------
REPORT_CLASSES = [
    ("분기", ["분기"]),
    ("반기", ["반기"]),
    ("연간", ["사업보고서", "연간"]),
]
REPORT_CODES = {"분기": "11013", "반기": "11012", "연간": "11011"}
CODE_ERROR = "코드오류"
NO_INFORMATION = "정보없음"
NOT_APPLICABLE = "해당없음"

# --- fixed values: listing responses ---------------------------------------------------------------------
STATUS_OK = "000"
STATUS_EMPTY = ["013", "014"]
PERIODIC = "A"

# --- fixed values: code widths ---------------------------------------------------------------------------
COMPANY_CODE_WIDTH = 8
STOCK_CODE_WIDTH = 6

# --- fixed values: roster header fragments ---------------------------------------------------------------
ROSTER_HEADERS = {
    "corp_code": ["corp_code", "회사코드"],
    "corp_name": ["corp_name", "회사명", "corp_eng_name"],
    "stock_code": ["stock_code", "종목코드"],
}

# --- fixed values: headings that announce the roster table, with their scores -----------------------------
KEYWORD_SCORES = [
    ("가. 임원의 현황", 100),
    ("가. 등기임원", 90),
    ("가. 임원 현황", 85),
    ("등기임원", 70),
    ("임원 현황", 60),
    ("나. 등기임원의 타회사 겸직 현황", -10),
    ("나. 등기임원", -10),
    ("나. 임원", -10),
]
CONCURRENT_WORD = "겸직"
CONCURRENT_PENALTY = 50
CONTEXT_CHARS = 200
CONTEXT_SIBLINGS = 2
TOKEN_BONUS = 20
HEADER_BONUS = 15
MIN_TOKENS = 6
HEADER_TOKENS = [
    "성명", "성별", "출생년월", "직위", "등기임원", "상근", "담당",
    "주요경력", "소유주식수", "의결권있는주식", "의결권없는주식",
    "최대주주와의관계", "재직기간", "임기만료일",
]
BONUS_WORDS = ["성명", "직위", "임기"]

# --- fixed values: document hint, first fragment found wins; the last value is the fallback ---------------
HINTS = ["가. 임원의 현황", "가. 등기임원", "가. 임원 현황", "등기임원"]
HINT_FALLBACK = "임원 현황"
HINT_TRIGGERS = ["등기임원", "임원 현황", "임원의 현황"]

# --- fixed values: the canonical record, internal name -> label -------------------------------------------
RECORD_LABELS = {
    "name": "성명",
    "gender": "성별",
    "birth_ym": "출생년월",
    "position": "직위",
    "registered": "등기임원여부",
    "full_time": "상근여부",
    "duty": "담당업무",
    "career": "주요경력",
    "school": "학교",
    "department": "학과",
    "prof_title": "교수",
    "shares_voting": "소유주식수(의결권O)",
    "shares_nonvoting": "소유주식수(의결권X)",
    "holder_relation": "최대주주와의 관계",
    "tenure": "재직기간",
    "term_end": "임기만료일",
}
RECORD_FIELDS = list(RECORD_LABELS)

# --- fixed values: labels of the two exported tables ------------------------------------------------------
SUMMARY_LABELS = {"company": "회사", "stock_code": "종목코드", "report_type": "구분", "url": "url"}
EXECUTIVE_LABELS = {
    "company": "회사",
    "stock_code": "종목코드",
    "name": "성명",
    "duty": "담당업무",
    "career": "주요경력",
    "school": "학교",
    "department": "학과",
    "prof_title": "교수",
}

# --- fixed values: academic titles, in the order they are looked for ---------------------------------------
PROFESSOR_TITLES = ["교수", "부교수", "조교수", "전임강사", "임용교수"]

# --- fixed values: header fragments (whitespace removed, lower case) -> record field ------------------------
HEADER_SYNONYMS = [
    ("성명", "name"), ("이름", "name"), ("name", "name"),
    ("성별", "gender"),
    ("출생년월", "birth_ym"),
    ("직위", "position"), ("직책", "position"), ("position", "position"),
    ("등기임원", "registered"),
    ("상근", "full_time"),
    ("담당업무", "duty"), ("담당", "duty"),
    ("주요경력", "career"),
    ("최대주주와의관계", "holder_relation"),
    ("재직기간", "tenure"),
    ("임기", "term_end"), ("만료일", "term_end"),
]
SHARE_WORDS = ["소유", "주식"]
VOTING_RIGHT = "의결권"
VOTING_WORDS = ["있는", "O"]
NONVOTING_WORDS = ["없는", "X"]

# --- fixed values: bullets between duties -------------------------------------------------------------------
BULLETS = "ㆍ·•"
