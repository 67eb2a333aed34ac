"""Character classes and word lists. Results depend on them."""

#: Ranges of CJK characters and the punctuation that counts as such.
CJK_RANGES = (
    (0x4E00, 0x9FFF), (0x3400, 0x4DBF), (0x20000, 0x2A6DF), (0x2A700, 0x2B73F), (0x2B740, 0x2B81F), (0x2B820, 0x2CEAF), (0x2CEB0, 0x2EBEF),
    (0x2EBF0, 0x2EE5F), (0x30000, 0x3134F), (0x31350, 0x323AF), (0x323B0, 0x3347F), (0x2F00, 0x2FDF), (0x2E80, 0x2EFF), (0xF900, 0xFAFF),
    (0x2F800, 0x2FA1F), (0x3200, 0x32FF), (0x3300, 0x33FF), (0x3000, 0x303F), (0xFF00, 0xFFEF), (0xFE30, 0xFE4F), (0x2000, 0x206F),
)
#: Characters that mask names, and those of them that look like the letter X.
MARKERS, X_MARKERS = "×XxＸｘ*＊∗✱﹡⁎٭※", "XxＸｘ"
#: Ideographs that Unicode has taken in since Java's tables; never "other" characters.
NEWER = ((0x9FFD, 0x9FFF), (0x4DB6, 0x4DBF), (0x2A6DE, 0x2A6DF), (0x2B735, 0x2B739), (0x2EBF0, 0x2EE5D), (0x31350, 0x323AF))
#: White space as text trimming sees it.
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same, character by character.
SPACES = "".join(chr(c) for a, b in ((9, 13), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)) for c in range(a, b + 1))
HAN = r"\u4e00-\u9fff"
#: Endings of document types; the first in this order that a title ends with is its type.
TYPE_SUFFIXES = (
    "不予受理支付令申请通知书", "不予暂予监外执行决定书", "刑事附带民事公益诉讼判决书", "终结本次执行程序执行裁定书", "财产保全告知事项通知书",
    "申请执行案件结案通知书", "刑事附带民事判决书", "刑事附带民事裁定书", "强制清算与破产裁定书", "执行案件结案通知书", "执行案件执行裁定书",
    "执行保全结案通知书", "诉讼保全结案通知书", "保全案件结案通知书", "案件执行结束通知书", "执行案件完毕通知书", "执行案件受理通知书",
    "暂予监外执行决定书", "非诉保全审查裁定书", "非诉行政执行裁定书", "国家司法救助决定书", "国家赔偿决定书", "行政赔偿判决书", "行政赔偿裁定书",
    "行政执行裁定书", "保全结案通知书", "保全情况通知书", "执行结案通知书", "执行完毕通知书", "终结结案通知书", "受理案件通知书", "协助执行通知书",
    "恢复执行通知书", "指定管辖决定书", "执行协调决定书", "司法救助决定书", "收监执行决定书", "民事判决书", "刑事判决书", "行政判决书", "民事裁定书",
    "刑事裁定书", "行政裁定书", "执行裁定书", "民事调解书", "刑事调解书", "行政调解书", "民事决定书", "刑事决定书", "执行决定书", "拘留决定书",
    "罚款决定书", "复议决定书", "再审决定书", "执行通知书", "结案通知书", "受理通知书", "应诉通知书", "执结通知书", "销案通知书", "民事支付令",
    "民事令", "刑事令", "行政令", "支付令", "判决书", "裁定书", "决定书", "通知书", "调解书", "案件移送函", "保全复函",
)
#: Words that a document type ends with, and those that mark a centred line as one.
TYPE_ENDINGS = ("裁定书", "判决书", "决定书", "通知书", "调解书", "裁决书", "支付令")
TYPE_KEYWORDS = ("裁定书", "判决书", "决定书", "通知书", "调解书")
#: Roles in signatures, as they are named, and as they are recognised with letters apart.
ROLES = ("人民陪审员", "校对责任人", "打印责任人", "法官助理", "审判长", "审判员", "书记员", "执行员", "校对人")
SIGNING = ("审判长", "审判员", "人民陪审员", "书记员", "法官助理", "执行员", "校对人", "校对责任人", "打印人", "打印责任人")
#: Provinces, in the order in which a court's name is tried for them.
PROVINCES = (
    "北京市", "天津市", "上海市", "重庆市", "河北省", "山西省", "辽宁省", "吉林省", "黑龙江省", "江苏省", "浙江省", "安徽省", "福建省", "江西省", "山东省",
    "河南省", "湖北省", "湖南省", "广东省", "海南省", "四川省", "贵州省", "云南省", "陕西省", "甘肃省", "青海省", "台湾省", "内蒙古自治区", "广西壮族自治区",
    "西藏自治区", "宁夏回族自治区", "新疆维吾尔自治区", "香港特别行政区", "澳门特别行政区",
)
MUNICIPALITIES = ("北京市", "天津市", "上海市", "重庆市")
#: Seats of provincial governments, and courts' names for municipalities: what locations are looked up in unless a fuller table is given.
CITIES = {
    "北京": "北京市", "天津": "天津市", "上海": "上海市", "重庆": "重庆市", "石家庄": "河北省", "太原": "山西省", "沈阳": "辽宁省", "长春": "吉林省",
    "哈尔滨": "黑龙江省", "南京": "江苏省", "杭州": "浙江省", "合肥": "安徽省", "福州": "福建省", "南昌": "江西省", "济南": "山东省", "郑州": "河南省",
    "武汉": "湖北省", "长沙": "湖南省", "广州": "广东省", "海口": "海南省", "成都": "四川省", "贵阳": "贵州省", "昆明": "云南省", "西安": "陕西省",
    "兰州": "甘肃省", "西宁": "青海省", "呼和浩特": "内蒙古自治区", "南宁": "广西壮族自治区", "拉萨": "西藏自治区", "银川": "宁夏回族自治区", "乌鲁木齐": "新疆维吾尔自治区",
}


def java_class(ranges) -> str:
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges)


CJK = java_class(CJK_RANGES)
#: A run of markers that masks something. A run with an X but no two in a row must not touch a Latin letter; a lone × before a digit or point multiplies.
MASKED = (
    rf"(?<![{MARKERS}])(?!×[\d.])(?:(?=[{MARKERS}]*[{X_MARKERS}][{X_MARKERS}])[{MARKERS}]++"
    rf"|(?![{MARKERS}]*[{X_MARKERS}])[{MARKERS}]++|(?<![A-WYZa-wyz])[{MARKERS}]++(?![A-WYZa-wyz]))"
)
TEMPLATE = r"\{\{PRC-redact\|(\d+)\}\}"
#: How a line about a party starts. Fixed value.
PARTY = "^(?:原告|被告|被告人|上诉人|被上诉人|申请人|被申请人|再审申请人|被执行人|申请执行人|第三人|公诉机关|抗诉机关|法定代表人|法定代理人|负责人|经营者|委托诉讼代理人|诉讼代理人|委托代理人|代理人|辩护人|指定辩护人|(?:[一二三四五六七八九十两0-9０-９]+)?(?:原告|被告|上诉人|被上诉人|申请人|被申请人|第三人)?(?:共同)?(?:委托诉讼代理人|诉讼代理人|委托代理人|代理人|辩护人))[：:]"
