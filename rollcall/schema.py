"""Declared schemas and the fixed values the jobs share."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(spec: str) -> T.StructType:
    """Struct of simple types; needs no running session."""
    out = T.StructType()
    for part in spec.split(","):
        out.add(*part.split())
    return out


CATALOG = _fields(
    "name string, is_integrated string, workflow_status string, company string, "
    "region string, openness string, size string, type string, reasoning string, "
    "task_type string, website string, note string, created_at string, "
    "released_at string, is_new string, verification string"
)
CATALOG_COLUMNS = CATALOG.fieldNames()

RECORDS = T.ArrayType(T.MapType(T.StringType(), T.StringType()))

ARENA = _fields(
    "model_id string, model_name string, organization string, conservative_rating double, "
    "matches_played long, win_rate double, avg_generation_price double, is_open_source boolean"
)

ARTICLE_INDEX = _fields(
    "seq long, title string, summary string, link string, published string, "
    "reads string, comments string"
)

MENTION_FIELDS = [
    "model_name", "company", "domestic", "open_source", "size", "model_type",
    "can_reason", "task_type", "release_date", "release_date_source", "website", "brief",
]

# mention field -> catalog column that an upsert may fill
MENTION_TO_CATALOG = {
    "company": "company",
    "domestic": "region",
    "open_source": "openness",
    "size": "size",
    "model_type": "type",
    "can_reason": "reasoning",
    "task_type": "task_type",
    "website": "website",
    "brief": "note",
}

VERDICT = (
    _fields("model_name string, should_remove boolean")
    .add("corrections", T.MapType(T.StringType(), T.StringType()))
    .add("confidence", "string")
    .add("importance", "string")
    .add("importance_reason", "string")
    .add("issues", T.ArrayType(T.StringType()))
    .add("notes", "string")
)

REGISTRY = (
    _fields("repo_id string, params_total long")
    .add("tags", T.ArrayType(T.StringType()))
    .add("pipeline_tag", "string")
    .add("login_required", "boolean")
)

OTHER_SOURCE = "other"  # where a record's source has no tag

# ---- fixed values: they are data, and results depend on them as written ----

SENTINEL = "$undefined"

BLANK_FILL = ["", "nan", "None", "未知"]
BLANK_DATE = ["", "nan", "None"]
BLANK_REVIEW = ["", "nan", "未知"]

DOMESTIC, FOREIGN = "国内", "国外"
OPEN, CLOSED, UNKNOWN = "开源", "闭源", "未知"
HIGH, MEDIUM, LOW = "高", "中", "低"
DASH = "—"
NEW_FLAGS = ["new", "是"]

DOMESTIC_ORGS = [
    "alibaba", "qwen", "baidu", "bytedance", "tencent", "deepseek",
    "zhipu", "minimax", "moonshot", "stepfun", "sensetime", "01.ai",
    "iflytek", "kuaishou", "huawei", "xiaomi", "vivo", "meituan",
    "jd", "honor", "oppo", "bilibili", "netease",
]

PRODUCT_NAMES = [
    "chatgpt", "cursor", "copilot", "豆包", "元宝", "千问", "即梦",
    "manus", "codebuddy", "sora", "claude code", "devin", "replit",
    "钉钉悟空", "飞书aily", "通义千问", "文心一言", "kimi", "智谱清言",
    "openai codex", "github copilot", "base44", "快乐小马", "龙虾",
    "chatgpt images", "deep research",
]

CODE_WORDS = ["code", "codex", "coder"]
AUDIO_WORDS = ["whisper", "tts", "stt", "speech", "audio", "voice", "vox"]
REASONING_WORDS = ["thinking", "reason", "o1", "o3", "o4", "r1", "r2"]

LICENSE_NAMES = {
    "apache_2_0": "Apache 2.0",
    "apache_2.0": "Apache 2.0",
    "apache-2.0": "Apache 2.0",
    "mit": "MIT",
    "modified_mit_license": "MIT (modified)",
    "gpl_3_0": "GPL 3.0",
    "cc_by_4_0": "CC BY 4.0",
    "cc_by_nc_4_0": "CC BY-NC 4.0",
    "llama3": "Llama 3 License",
    "llama3.1": "Llama 3.1 License",
    "gemma": "Gemma License",
    "qwen": "Qwen License",
    "deepseek": "DeepSeek License",
}

ORG_SLUGS = {
    "moonshotai": ["moonshotai", "moonshot-ai"],
    "alibaba": ["Qwen", "alibaba-nlp", "modelscope"],
    "qwen": ["Qwen"],
    "google": ["google"],
    "meta": ["meta-llama", "facebook"],
    "openai": ["openai"],
    "anthropic": ["anthropic"],
    "mistral": ["mistralai"],
    "zhipu": ["THUDM"],
    "deepseek": ["deepseek-ai"],
    "bytedance": ["bytedance-research"],
    "01-ai": ["01-ai"],
    "nvidia": ["nvidia"],
    "microsoft": ["microsoft"],
    "tencent": ["tencent"],
    "xiaomi": ["xiaomi"],
    "stepfun": ["stepfun"],
    "minimax": ["MiniMaxAI"],
    "nous-research": ["NousResearch"],
    "sarvam-ai": ["sarvamai"],
}

# markers of the embedded arrays, in the order they are tried
PAYLOAD_KEYS = ["initialHomepageLLMModels", "initialData", "recentUpdates"]
PAYLOAD_CHUNK = r'(?s)self\.__next_f\.push\(\[1,"(.*?)"\]\)'
PAYLOAD_OBJECT = r'\{"model_id":"[^"]+?".*?\}'

# keys a reply may use for the entity name, in the order they are tried
REPLY_NAME_KEYS = ["model_name", "name", "模型名称", "model", "modelName"]

ARTICLE_TITLE, ARTICLE_LINK, ARTICLE_SEQ = "标题:", "链接:", "序号:"
FAILED_BODY_PREFIXES = ["[爬取失败]", "[内容过短]"]

NO_MENTIONS, ALL_TRACKED = "无明确新模型", "均已追踪"

RELEASE_TYPES = [
    "Release", "Preview", "Pro", "Fast", "Update", "Turbo", "Lite", "Max", "Mini",
]
FLAG_COUNTRIES = {"🇺🇸": "美国", "🇨🇳": "中国", "🇫🇷": "法国", "🇮🇳": "印度"}
FLAG_LETTERS = "🇦🇨🇪🇫🇮🇳🇺🇸🇷"
COMPANY_LINES = [
    "Google", "OpenAI", "Anthropic", "Meta", "Zhipu AI", "ZAI",
    "Qwen", "Xiaomi", "MiniMax", "Mistral", "Nvidia", "Sarvam AI",
]
TTS_VENDORS = ["elevenlabs", "deepgram", "cartesia"]
