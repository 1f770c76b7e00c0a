"""Default constants of the comment pipeline. Results depend on them."""

LOW_INFO = ("顶", "顶！", "顶。", "冲", "冲！", "1", "支持", "顶上去")
MOBILIZATION = ("顶", "冲", "战", "扩", "转")
TOPICS = (("认错态度", "认错"), ("认错态度", "道歉"), ("处理方案", "处理"), ("处理方案", "方案"), ("处罚诉求", "处罚"), ("处罚诉求", "名单"), ("处罚诉求", "严惩"), ("产品改动", "回退"), ("产品改动", "动作"), ("产品改动", "鞋子"), ("自定义功能", "自定义"), ("公关质疑", "公关"), ("性别或群体对立", "男玩家"), ("性别或群体对立", "集美"))
RISKS = (("辱骂攻击", "护主犬"), ("煽动动员", "顶"), ("煽动动员", "冲"), ("群体对立", "男玩家"), ("群体对立", "集美"), ("极端表达", "杀"))
SHORT, LOW_INFO_LENGTH, HIGH_LIKES, HIGH_REPLIES, LONG = 4, 2, 50, 10, 12

SENTIMENTS = ("正面", "中性", "负面", "混合", "无法判断")
STANCES = ("支持官方处理", "反对官方处理", "要求进一步处理", "产品诉求导向", "跟随主评动员", "观望", "无法判断")
TOPIC_TAGS = ("认错态度", "处理方案", "处罚诉求", "产品改动", "自定义功能", "性别或群体对立", "公关质疑", "无明确主题")
RISK_TAGS = ("辱骂攻击", "煽动动员", "群体对立", "极端表达", "无明显风险")
INTENSITIES = ("低", "中", "高", "无法判断")
SENTIMENT_ALIASES = {"正面": ("positive", "积极", "支持"), "中性": ("neutral", "中立"), "负面": ("negative", "消极", "反对", "不满", "愤怒"), "混合": ("mixed",), "无法判断": ("unknown", "uncertain")}
STANCE_ALIASES = {"支持官方处理": ("support", "support_official_handling"), "反对官方处理": ("against", "against_official_handling", "disapproval", "反对"), "要求进一步处理": ("request_further_action", "request_more_action", "punitive"), "产品诉求导向": ("product_demand", "product_request"), "跟随主评动员": ("follow_mobilization", "mobilization"), "观望": ("wait_and_see", "observe"), "无法判断": ("unknown", "uncertain")}
INTENSITY_ALIASES = {"低": ("low", "低"), "中": ("medium", "中等"), "高": ("high", "强", "高"), "无法判断": ("unknown", "uncertain")}
CONFIDENCE_WORDS = {0.9: ("high", "高"), 0.6: ("medium", "中", "中等"), 0.3: ("low", "低")}
TOPIC_ALIASES = {"无明确主题": ("其他", "other", "default", "military", "social_values", "对个人的评价", "公共管理", "民族情绪", "历史事件", "comment_on_parent", "网络文化")}
RISK_ALIASES = {"煽动动员": ("煽动情绪", "煽动性言论"), "极端表达": ("极端立场",)}
DROPPED_RISKS = ("质疑官方", "问责诉求")
BARE_SUPPORT = ("支持", "supportive")

#: White space as Python has it; and the canonical form's classes.
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
#: The same, one by one.
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
BRACKET_TAG = r"\[[^\[\]]{1,10}\]"
EMOJI = ((0x1F600, 0x1F64F), (0x1F300, 0x1F5FF), (0x1F680, 0x1F6FF), (0x1F1E0, 0x1F1FF), (0x2702, 0x27B0), (0x1F900, 0x1F9FF), (0x1FA00, 0x1FA6F), (0x1FA70, 0x1FAFF), (0x2600, 0x26FF), (0xFE00, 0xFE0F), (0x200D, 0x200D), (0x2B50, 0x2B50), (0x23CF, 0x23CF), (0x23E9, 0x23F3), (0x23F8, 0x23FA))
#: Neither a straight double quote nor a backslash is in it.
PUNCTUATION = "，。！？、；：'【】《》（）()[]{}<>/@#$%^&*-_+=|~`…·\u200b\u200c\u200d\ufeff"
#: All that goes character by character, each once: a table to look up, as a regular expression tries its ranges one after another.
REMOVED = "".join(dict.fromkeys("".join(chr(x) for low, high in EMOJI for x in range(low, high + 1)) + PUNCTUATION + WS_CHARS))


def sign_class(signs: str) -> str:
    """A regular expression's class of the signs: a bit set of those below 256, and ranges that only signs from the first high one on are compared with."""
    high = sorted(ord(x) for x in signs if ord(x) >= 256)
    starts = [x for x in high if x - 1 not in set(high)]
    ends = [x for x in high if x + 1 not in set(high)]
    ranges = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends, strict=True))
    return "[" + "".join(f"\\x{ord(x):02x}" for x in signs if ord(x) < 256) + f"[\\x{{{high[0]:x}}}-\\x{{10ffff}}&&[{ranges}]]]"


#: What goes, and white space but for the blank.
REMOVED_CLASS, ODD_WS = sign_class(REMOVED), sign_class(WS_CHARS.replace(" ", ""))
SYMBOLS_ONLY = r"^[\p{P}\p{S}\s\x0b\x1c-\x1f\x85\p{Z}]+$"
