"""Problem 6: unfilled templates, filler, error pages and script notices in place of content.

A cell is cut into lines (at line ends and after sentence stops). Lines are
normalised (case, digits, spaces) and counted per host. A line that recurs in
a host's records *beside other content* is boilerplate of that host and is
subtracted; a message that makes up the whole cell each time is not. A cell is
excluded when its residual lines hold evidence of one of four kinds: slots,
stand-ins and filler, error or access messages, script notices.

Only lines with evidence can change the outcome, so only those are counted;
the rest of the text never shuffles, and these few lines are checkpointed
since they are read twice. Counting is a partial aggregate per
(host, line), which no host's size can skew.

Defined results: blank cells are never residue; a NULL host counts as a host
of its own; very long texts are judged line by line in full.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, checkpointed, is_blank, stripped

#: Share of a host's cells, and least number, from which a line beside other content is boilerplate.
BOILERPLATE_SHARE, BOILERPLATE_LEAST, BESIDE_SHARE = 0.002, 5, 0.6

# The ways in which template languages write a slot.
SLOTS = (
    r"\$!?\{[^{}\n]{0,60}\}", r"#\{[^{}\n]{1,60}\}", r"\{\{[^{}\n]{1,60}\}\}", r"\{%[^\n]{1,60}?%\}", r"<%=?[^\n]{1,60}?%>",
    r"\[\[[^\]\n]{1,60}\]\]", r"\[%[^\n]{1,60}?%\]", r"%%[^%\s]{1,60}%%", r"@@[^@\s]{1,60}@@", r"(?<![\w_])__[^\s_][^\s]{0,58}?__(?![\w_])",
    r"待填[】>\])）]", r"\{[A-Za-z_][A-Za-z_.]{1,40}\}", r"\{[一-龥]{1,10}\}",
    r"(?:\$!?\{|#\{|\{\{|<%=|\[\[|\{%|\[%)[^{}\[\]%\n]{0,40}$",
)
# Words and phrases that stand where content should be.
STAND_IN_LINES = (
    r"暂无.{0,6}", r"待补充", r"待完善", r"待更新", r"待填写?", r"待定", r"待录入", r"未填写?", r"尚未填写", r"无简介", r"null", r"undefined", r"nan", r"none", r"nil",
    r"n/?a", r"tbd", r"tba", r"todo", r"\[?object object\]?", r"not available(?: yet)?", r"(?:页面)?加载中.{0,8}", r"loading", r"(?:测试)+", r"test",
)
_LOREM = r"(?:lorem|ipsum|dolor|amet|tempor|minim|velit|aliqua|erat|elit)\b"
STAND_INS = (
    r"请输入", r"请在此", r"在此输入", r"此处填写", r"在此填写", r"尚未填写", r"正在完善", r"完善中", r"内容更新中", r"资料整理中", r"敬请期待", r"稍后再来", r"please enter", r"enter your",
    r"your (?:e-?mail|text|name|bio\w*) here", r"under construction", r"coming soon", r"no description has been", r"to be (?:filled|added|announced)", r"not available yet",
    r"lorem ipsum", r"dolor sit amet", *[rf"{w}\b\W+(?:(?!{_LOREM})\w+\W+){{0,5}}{_LOREM}\W+(?:(?!{_LOREM})\w+\W+){{0,5}}{_LOREM}" for w in ("lorem", "ipsum", "dolor", "amet", "tempor", "minim", "velit", "aliqua", "erat", "elit")], r"placeholder text", r"示例文字", r"文本内容", r"这里是(?:标题|内容|正文)", r"点击(?:显示|查看)邮箱", r"电子邮箱地址", r"e-?mail地址", r"邮箱未公开", r"暂无邮箱",
)
FILLER = (r"^\s*(.{2,20}?)\1+[。.…]*\s*$", r"^\s*(.)\1{3,}[。.…]*\s*$", r"^\s*(.{2,20}?)(?:\s*\1){2,}[。.…\s]*$")
# Error and access messages.
ERRORS = (
    r"http\s?(?:错误|error)", r"错误(?:代码|码)?[:： ]*[45]\d\d", r"error[: ]+[45]\d\d\b", r"status[: ]+[45]\d\d\b",
    r"[45]\d\d\s+(?:not found|forbidden|bad \w+|(?:internal )?server error|service unavailable|unavailable|(?:gateway )?time-?out|unauthori[sz]ed|internal|moved|gone)",
    r"page (?:you (?:are|were) looking for|not found|cannot be)", r"gone or has moved", r"access (?:is )?denied", r"was blocked by", r"页面(?:不存在|走丢|已(?:被)?删除|无法访问|出错|未找到)",
    r"您访问的", r"系统繁忙", r"服务器(?:错误|异常|繁忙|内部错误|无响应)", r"数据库(?:连接|错误|异常)", r"err_[a-z]", r"java\.(?:lang|io|sql|util)\.", r"nullpointer", r"stack ?trace", r"traceback",
    r"session (?:has )?expired", r"sign in again", r"登录已(?:超时|过期|失效)", r"重新登录", r"登录后查看", r"没有权限", r"无权(?:限)?访问", r"仅限校内", r"访问过于频繁", r"站点正在维护", r"暂停服务", r"请求超时",
    r"解码失败", r"解析失败", r"加载失败", r"连接失败", r"decode service", r"service returned", r"missing variable", r"warning: ", r"notice: ", r"fatal error: ", r"on line \d+", r"undefined (?:index|variable)", r"返回首页",
    r"稍[后候](?:重试|再试)", r"分钟后再试", r"请刷新",
)
# Notices that scripts, cookies or another browser are needed.
SCRIPTS = (
    *[rf"{verb}(?:您的)?\s*(?:cookie[s]?(?:和|与))?(?:javascript|脚本|cookie)" for verb in ("启用", "开启", "打开", "允许运行", "运行", "不支持", "需要", "禁用")],
    *[rf"{what}(?:已|被|支持)*(?:禁用|支持|关闭)" for what in ("javascript", "脚本", "cookies?")],
    *[rf"{verb}\s+(?:\w+\s+){{0,2}}(?:java)?scripts?\b" for verb in ("enable", "turn(?:ed)? on", "switch(?:ed)? on", "needs?", "requires?", "allow")], r"scripts?\s+(?:and cookies\s+)?(?:are|is|were)\s+(?:switched|turned|disabled|required|needed|blocked)",
    r"cookies? to continue", r"noscript", r"javascript:\s*void", r"浏览器不支持", r"新版浏览器", r"浏览器环境", r"checking your browser", r"hidden from robots", r"protected from spam", r"\[email protect",
)
# Names that stand-in addresses are made of.
ADDRESSES = (
    r"@\s*(?:[\w.\-]*\.)?(?:invalid|example|localhost|xxx?|ccc|null|undefined)\W*$", r"@\s*(?:example|domain|somewhere|yourdomain|localhost)\.\w+\W*$",
    r"@\s*(\w+)\.\1\W*$", r"^[\W_]+$", r"姓名@", r"^\W*(?:your\s?name|user\s?name|xxx+|aaa+)@",
)


def _matches(text: Column, patterns: tuple[str, ...]) -> Column:
    """Whether any pattern occurs; look-ahead and word boundary skip positions at which none can begin."""
    kinds: dict[str, list[str]] = {"han": [], "word": [], "other": []}
    for p in patterns:
        han = "\u4e00" <= p[0] <= "\u9fff" and p[1:2] not in ("?", "*")
        kinds["han" if han else "word" if p[0].isascii() and p[0].isalpha() or p.startswith("[45]") else "other"].append(p)
    alternatives = list(kinds["other"])
    if kinds["word"]:
        starts = "".join(sorted({p[0] for p in kinds["word"]} - {"["})) + "45"
        alternatives.append(rf"(?=[{starts}])\b(?:" + "|".join(kinds["word"]) + ")")
    if kinds["han"]:
        starts = "".join(sorted({p[0] for p in kinds["han"]}))
        alternatives.append(f"(?=[{starts}])(?:" + "|".join(kinds["han"]) + ")")
    return F.lower(text).rlike("|".join(f"(?:{p})" for p in alternatives))


_SLOT = "|".join(f"(?:{p})" for p in SLOTS)
#: A sign that every slot holds.
_SLOT_SIGN = r"[{<\[%]|@@|__|待填"


def _slots(text: Column) -> Column:
    return text.rlike(_SLOT_SIGN) & text.rlike(_SLOT)


def _stand_in_line(line: Column) -> Column:
    body = "|".join(f"(?:{p})" for p in STAND_IN_LINES)
    return (F.length(line) <= 60) & line.rlike(rf"(?U)(?i)^[^\w\[{{]*(?:{body})[^\w（(]*(?:[（(].{{0,12}}[）)])?[^\w]*$")


def _filler(line: Column) -> Column:
    out = F.lit(False)
    for p in FILLER:
        out = out | line.rlike(p)
    return out & ~line.rlike(r"^(?:1919|2020)[。.…]*$")  # a year


#: Where a line of ``lines_of`` may begin.
_BEGIN = r"(?:^|[\r\n。！？]|[.!?]\s)"


def literals(pattern: str) -> frozenset[str]:
    """Literals of which every text that the pattern matches holds one; empty if none can be told."""

    def weight(found: frozenset[str]) -> int:
        return min((sum(1 if c.isascii() else 2 for c in w) for w in found), default=0)

    def needed(parts: Iterable) -> frozenset[str]:
        options, run = [], ""
        for kind, value in [*parts, ("END", None)]:
            if str(kind) == "LITERAL":
                run += chr(value)
                continue
            options.append(frozenset({run} if run else ()))
            run = ""
            if str(kind) == "SUBPATTERN":
                options.append(needed(value[-1]))
            elif str(kind) == "BRANCH":
                each = [needed(b) for b in value[1]]
                options.append(frozenset().union(*each) if all(each) else frozenset())
            elif str(kind) in ("MAX_REPEAT", "MIN_REPEAT") and value[0] > 0:
                options.append(needed(value[2]))
        return max(options, key=weight)

    return needed(re._parser.parse(pattern))


def _linear() -> str:
    """What RE2 runs in one pass: all phrases, slot signs and stand-ins where a line may begin; phrases that look around by their literals."""
    phrases = [p if "(?!" not in p else "|".join(map(re.escape, literals(p))) for p in (*SCRIPTS, *ERRORS, *STAND_INS)]
    phrases = [f"(?:{p})".replace(r"\s", r"[\s\x0b]") for p in phrases]
    words = "|".join(f"(?:{p})" for p in STAND_IN_LINES)
    return "|".join([*phrases, _SLOT_SIGN, rf"{_BEGIN}[^\pL\p{{Nd}}\pM_\[{{]*(?:{words})"])


def _back_referring(address: bool) -> Callable[[str], bool]:
    """The rest: stand-in addresses, or signs repeated where a line may begin."""
    if address:
        found = re.compile("(?i)" + "|".join(f"(?:{p})" for p in ADDRESSES)).search
        return lambda v: found(v) is not None
    repeated = r"\s*(.{2,20}?)\s*\1"
    first, later = re.compile(repeated).match, re.compile(rf"[\r\n。！？.!?]{repeated}").search
    return lambda v: first(v) is not None or later(v) is not None


def screened(cells: DataFrame, address: bool) -> DataFrame:
    """The cells (``value`` not NULL) that may hold evidence: all that do, and few others.

    The many phrases are searched by one automaton over whole Arrow columns;
    as a Java pattern they would be tried one by one at every sign.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linear, other = _linear(), _back_referring(address)
        for batch in batches:
            value = batch.column("value")
            hit = pc.match_substring_regex(value, linear, ignore_case=True)
            kept = [h or other(v) for h, v in zip(hit.to_pylist(), value.to_pylist())]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return cells.mapInArrow(keep, cells.schema)


def evidence(line: Column, address: Column) -> Column:
    """Kind of evidence in a line ('slot', 'stand-in', 'error', 'script'), or NULL; ``address`` marks mail cells."""
    return (
        F.when(_slots(line), "slot")
        .when(_matches(line, SCRIPTS), "script")
        .when(_matches(line, ERRORS), "error")
        .when(_stand_in_line(line) | _matches(line, STAND_INS), "stand-in")
        .when(~address & _filler(line), "stand-in")
        .when(address & line.rlike("(?U)(?i)" + "|".join(f"(?:{p})" for p in ADDRESSES)), "stand-in")
    )


def lines_of(text: Column) -> Column:
    """The lines and sentences of a text, without blank ones."""
    parts = F.split(text, r"(?<=[。！？])|(?<=[.!?])\s+|[\r\n]+")
    return F.filter(F.transform(parts, lambda p: stripped(p)), lambda p: p != "")


def normalised(line: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(line), r"[0-9]+", "0"), rf"[{SPACE}]+", " ")


def residue(df: DataFrame, id_col: str, host: str, text_columns: tuple[str, ...], address_columns: tuple[str, ...]) -> DataFrame:
    """``id, field, evidence`` of every cell whose residual holds evidence."""
    host_of = F.coalesce(F.col(host), F.lit("")).alias("host")
    totals = df.groupBy(host_of).agg(F.count("*").alias("host_cells"))
    is_address = F.col("field").isin(*address_columns)

    def cells(columns: tuple[str, ...], address: bool) -> DataFrame:
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns])).alias("cell")
        known = df.select(F.col(id_col).alias("id"), host_of, each).select("id", "host", "cell.field", "cell.value")
        return screened(known.where(~is_blank("value")), address)

    parts = [cells(c, address) for c, address in ((text_columns, False), (address_columns, True)) if c]
    lines = checkpointed(
        reduce(DataFrame.unionByName, parts)
        .withColumn("lines", F.when(is_address, F.array(stripped("value"))).otherwise(lines_of(F.col("value"))))
        .withColumn("n_lines", F.size("lines"))
        .select("id", "host", "field", "n_lines", F.explode("lines").alias("line"))
        .withColumn("evidence", evidence(F.col("line"), is_address))
        .where("evidence IS NOT NULL")
        .withColumn("shape", normalised(F.col("line")))
    )
    counted = lines.groupBy("host", "field", "shape").agg(
        F.count("*").alias("n"), F.count_if(F.col("n_lines") > 1).alias("beside")
    )
    least = F.greatest(F.lit(BOILERPLATE_LEAST), F.col("host_cells") * F.lit(BOILERPLATE_SHARE))
    boilerplate = (
        counted.join(totals, "host")
        .where((F.col("n") >= least) & (F.col("beside") >= F.col("n") * F.lit(BESIDE_SHARE)))
        .select("host", "field", "shape")
    )
    left = lines.join(boilerplate, ["host", "field", "shape"], "left_anti")
    return left.groupBy("id", "field").agg(F.min("evidence").alias("evidence"))
