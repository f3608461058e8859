"""The registered queries once more, as plain SQL over the given tables.

Written from the semantics alone; it shares the fixed values with the operators and no logic.
"""

from __future__ import annotations

import re

from ledgerline.functions.rules import (
    FALSE_OPTIONS, FILING_URL, HEADER_KEYS, LONGEST_NAME, RULES, TOTAL_RULES, VALUE_TOTAL,
)
from ledgerline.plans.queries import PERIOD_QUARTERS, PERIOD_YEARS, SCORED, SCORE_RULES

WS = "chr(32)||chr(9)||chr(10)||chr(13)||chr(11)||chr(12)"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _rule(name: str) -> str:
    return _q("(?i)" + RULES[name])


def _strip(x: str) -> str:
    return f"trim({x}, {WS})"


def _column(key: str) -> str:
    return key.lower().replace(" ", "_")


ANY = _rule("Anyopt")
SKIP = _rule("SkipL")
FIELD = _q(r'("(?:[^"]|"")*"[^,]*|[^",][^,]*|),')
UNQUOTED = (
    "case when {0} like '\"%' then replace(regexp_extract({0}, '^\"((?:[^\"]|\"\")*)\"', 1), '\"\"', '\"')"
    " || regexp_extract({0}, '^\"(?:[^\"]|\"\")*\"(.*)$', 1) else {0} end"
)


def _opt(found: str, after: str) -> str:
    return (
        f"case when not regexp_matches({found}, {ANY}) then 'Unlikely'"
        f" when regexp_matches({after}, {ANY}) then regexp_extract({after}, {ANY}, 0)"
        f" else regexp_extract({found}, {ANY}, 0) end"
    )


def _modal(table: str, text: str, pattern: str, shift: int = 0) -> str:
    at = f"length(regexp_extract({text}, {_q('^(.*?)' + pattern)}, 1)) + {shift}"
    return f"""
      select file_id, pos from (
        select file_id, pos, row_number() over (partition by file_id order by count(*) desc, min(line_no)) as r
        from (select file_id, line_no, {at} as pos from {table} where regexp_matches({text}, {_q(pattern)}))
        group by file_id, pos) where r = 1"""


def _often(table: str, text: str, pattern: str, shift: int, side: str, neighbour: str) -> str:
    at = f"length(regexp_extract({text}, {_q('^(.*?)' + pattern)}, 1)) + {shift}"
    return f"""
      select a.file_id, '{side}' as side, a.pos, a.n from (
        select c.file_id, c.pos, c.n from (
          select file_id, pos, count(*) as n from (
            select file_id, {at} as pos from {table} where regexp_matches({text}, {_q(pattern)}))
          group by file_id, pos) c
        join votes v on v.file_id = c.file_id and v.layout = 'fixed' and c.n > v.n_split // 10) a
      where not exists (select 1 from (
        select c.file_id, c.pos, c.n from (
          select file_id, pos, count(*) as n from (
            select file_id, {at} as pos from {table} where regexp_matches({text}, {_q(pattern)}))
          group by file_id, pos) c
        join votes v on v.file_id = c.file_id and v.layout = 'fixed' and c.n > v.n_split // 10) b
        where b.file_id = a.file_id and b.pos = a.pos {neighbour})"""


def _total(total: str) -> str:
    rule = TOTAL_RULES[total]
    return (
        f"case when contains(lower(line), {_q(total.lower())})"
        f" then regexp_extract(lower(line) || chr(10), {_q(rule)}, 1) end"
    )


def _header_column(key: str) -> str:
    last = f"(max(struct_pack(l := line_no, v := value)) filter (key = {_q(key)})).v"
    if key not in TOTAL_RULES:
        start = {"CIK": "split_part(max(file_id), '_', 1)", "date": "split_part(max(file_id), '_', 2)"}
        return f"coalesce({last}, {start.get(key, _q(''))}) as {_column(key)}"
    name = _column(key)
    reset = f"max(r_{name})"
    said = f"(min(struct_pack(l := line_no, v := t_{name})) filter (t_{name} <> '' and line_no >= coalesce(r_{name}, -1))).v"
    return f"case when {reset} is not null and {last} <> '' then {last} else coalesce({said}, '') end as {name}"


SQUEEZE = "translate({}, chr(45)||chr(9)||chr(46)||chr(44)||chr(36), '')"

TABLES = {
    "fx_filings": """
      select o_orderkey as k,
        cast(c_custkey+1 as varchar)||'_'||cast(cast(o_orderdate as date) as varchar)||'_'||cast(o_orderkey+1 as varchar) as file_id,
        cast(c_custkey+1 as varchar) as cik, cast(cast(o_orderdate as date) as varchar) as filed_on,
        cast(year(o_orderdate) as int) as year, cast(quarter(o_orderdate) as int) as quarter, upper(c_name) as company,
        case o_orderkey % 4 when 0 then '13F-HR' when 1 then '13F-HR/A' when 2 then '13F-NT' else '10-K' end as form_type,
        lpad(cast(c_custkey+1 as varchar),10,'0')||'-'||substr(cast(cast(o_orderdate as date) as varchar),3,2)||'-'||lpad(cast(o_orderkey+1 as varchar),6,'0') as accession
      from orders join customer on o_custkey = c_custkey""",
    "fx_security": """
      select p_partkey as p,
        case when p_partkey % 13 = 0 then substr(lpad(cast(p_partkey*1009+1000007 as varchar),8,'0'),1,7)||'K'
             else lpad(cast(p_partkey*1009+1000007 as varchar),8,'0') end as id8,
        cast(p_partkey % 10 as varchar) as chk,
        substr(lpad(cast(p_partkey*1009+1000007 as varchar),8,'0'),1,6) as issuer,
        upper(p_name) as nm
      from part""",
    "fx_holdings": """
      select k, rn, pid, val, shr, nm, opt,
        case k % 5
         when 0 then nm||chr(9)||'COM'||chr(9)||pid||chr(9)||val||chr(9)||shr||chr(9)||'SH'||opt
         when 1 then '"'||nm||case when odd = 0 then 'INTERNATIONALHOLDINGSCORPORATION' else '' end||', INC",'||pid||','
           ||case odd when 1 then '' when 2 then pid else val end||','||shr||',SH,SOLE'||opt
         when 4 then pid||' '||substr(shr,1,2)
         else nm||repeat(' ', case when length(nm) < 20 then 20-length(nm) else 2 end)||'COM   '||pid||'   '||val||'   '||shr||' SH SOLE'||opt
           ||case when k % 7 = 0 and k % 5 = 2 and rn = 1 then '<html>' else '' end
        end as line
      from (
        select l_orderkey as k,
          cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus) as int) as rn,
          case (l_partkey + l_suppkey) % 6
            when 3 then substr(id8,1,6)||'-'||substr(id8,7,2)||'-'||chk
            when 4 then lower(id8)||chk
            when 5 then id8
            else id8||chk end as pid,
          l_partkey % 8 as odd, nm, cast(cast(floor(l_extendedprice) as bigint) as varchar) as val,
          cast(cast(l_quantity as bigint) as varchar) as shr,
          case when l_returnflag='R' and l_suppkey % 4 = 0 then ' CALL'
               when l_returnflag='A' and l_suppkey % 4 = 1 then ' PUT'
               when l_suppkey % 4 = 2 then ' CL A' else '' end as opt
        from lineitem join fx_security on l_partkey = p)""",
    "fx_sums": "select k, count(*) as n, sum(cast(val as bigint)) as total from fx_holdings group by k",
    "fx_lines": """
      select f.file_id, f.year, f.quarter, x.line_no, x.line from fx_filings f join (
        select k, 0 as line_no, '<SEC-HEADER>'||accession||'.hdr' as line from fx_filings
        union all select k, 1, 'ACCESSION NUMBER:'||chr(9)||accession from fx_filings
        union all select k, 2, 'CONFORMED SUBMISSION TYPE:'||chr(9)||form_type from fx_filings
        union all select k, 3, 'CONFORMED PERIOD OF REPORT:'||chr(9)||replace(filed_on,'-','') from fx_filings
        union all select k, 4, chr(9)||chr(9)||'COMPANY CONFORMED NAME:'||chr(9)||company from fx_filings
        union all select k, 5, chr(9)||chr(9)||'STREET 1:'||chr(9)||cik||' MAIN' from fx_filings
        union all select k, 6, chr(9)||chr(9)||'STREET 1:'||chr(9)||'BOX '||cik from fx_filings
        union all select k, 7, '</SEC-HEADER>' from fx_filings
        union all select k, 8, 'STREET 1: outside the header' from fx_filings
        union all select k, 9, 'Number of Other Included Managers: '||cast(k % 3 as varchar) from fx_filings
        union all select k, 10, 'Form 13F Information Table Entry Total:  '||cast(n as varchar) from fx_sums
        union all select k, 11, 'Form 13F Information Table Value Total: $ '||
           cast(cast(floor(total/1000) as bigint) as varchar)||','||lpad(cast(total % 1000 as varchar),3,'0') from fx_sums
        union all select k, 12, '<TABLE>' from fx_filings
        union all select k, cast(12+rn as int), line from fx_holdings
        union all select g.k, cast(13+coalesce(n,0) as int), '</TABLE>' from fx_filings g left join fx_sums s on s.k = g.k
      ) x on f.k = x.k""",
    "fx_master": "select id8 as cusip8, chk as issue_check, issuer as issuer_num from fx_security where p % 7 <> 0",
    "fx_list_a": "select id8 as cusip, substr(id8,1,7)||'9' as ncusip from fx_security where p % 7 in (1,2)",
    "fx_list_b": "select id8 as cusip from fx_security where p % 7 = 3",
    "fx_entities": """
      select lpad(cast(c_custkey+1 as varchar),10,'0') as reportedcik, cast(c_custkey+1 as varchar) as wrds_cik,
        case when c_custkey % 2 = 0 then lpad(cast(c_custkey+2 as varchar),7,'0') else '' end as cik_may16
      from customer where c_nationkey < 5""",
    "fx_index_lines": """
      select year, quarter, cik||'|'||company||' |'||form_type||'| '||filed_on||'|edgar/data/'||cik||'/'||accession||'.txt' as line from fx_filings
      union all select distinct year, quarter, 'Description: Master Index | of filings' from fx_filings
      union all select distinct year, quarter, 'CIK|Company Name|Form Type|Date Filed|Filename' from fx_filings
      union all select distinct year, quarter, '-----------------------------------------' from fx_filings""",
    "doc_lines": """
      select doc_id, cast(i - 1 as int) as line_no, parts[i] as line from (
        select doc_id, parts, unnest(range(1, len(parts) + case when parts[len(parts)] = '' then 0 else 1 end)) as i
        from (select doc_id, string_split_regex(text, '\\r\\n|\\r|\\n') as parts from documents))""",
    "doc_texts": "select 'doc_'||cast(doc_id as varchar) as file_id, line_no, line from doc_lines",
    "dict": """
      select distinct key from (
        select cusip8||issue_check as key from fx_master union all select issuer_num from fx_master
        union all select ltrim(issuer_num, '0') from fx_master union all select ltrim(cusip8, '0') from fx_master
        union all select ltrim(cusip8, '0')||issue_check from fx_master
        union all select cusip from fx_list_a union all select ltrim(cusip, '0') from fx_list_a
        union all select ncusip from fx_list_a union all select ltrim(ncusip, '0') from fx_list_a
        union all select cusip from fx_list_b union all select ltrim(cusip, '0') from fx_list_b)""",
}


def _resolved(lines: str) -> dict[str, str]:
    p = "" if lines == "fx_lines" else "doc_"
    return {
        p + "texts_in": f"""
          select file_id, line_no, rtrim(line, {WS}) as raw,
            regexp_matches(rtrim(line, {WS}), {SKIP}) as skipped,
            replace(rtrim(line, {WS}), '-', '') as line from {lines}""",
        p + "words": f"""
          select file_id, line_no, line, unnest(found) as word, generate_subscripts(found, 1) as i from (
            select file_id, line_no, line, regexp_extract_all(line, {_rule('CUSIP')}, 1) as found
            from {p}texts_in where not skipped)""",
        p + "eligible": f"""
          select file_id, line_no, cusip,
            regexp_extract(string_split(line, cusip)[-1], {_rule('Shprn')}, 1) as shprn, line
          from (select *, upper(word) as cusip,
              row_number() over (partition by file_id, line_no order by length(word) desc, i) as r
            from {p}words where upper(word) in (select key from dict) or upper(substr(word,1,6)) in (select key from dict))
          where r = 1""",
        p + "remainder": f"""
          select t.file_id, t.line_no, case when skipped then raw else t.line end as line
          from {p}texts_in t left join (select file_id, line_no, true as found from {p}eligible) e
            on e.file_id = t.file_id and e.line_no = t.line_no where e.found is null""",
    }


TABLES |= _resolved("fx_lines") | _resolved("doc_texts")
TABLES |= {
    "split_all": """
      select *, rtrim(substr(line, 1, instr(line, cusip) - 1), chr(44)||chr(9)) as before,
        ltrim(substr(line, instr(line, cusip) + length(cusip)), chr(44)||chr(9)) as after
      from eligible where contains(line, cusip)""",
    "votes": f"""
      select *, case when n_tab > n_lines // 2 then 'tab' when n_csv > n_lines // 2 then 'csv'
          when n_html > 0 then 'html' when n_garbage > n_lines // 2 then 'garbage' else 'fixed' end as layout
      from (select file_id, count(*) as n_lines,
          count(*) filter (contains(line, cusip)) as n_split,
          count(*) filter (contains(line, cusip) and contains(line, chr(9))) as n_tab,
          count(*) filter (contains(line, cusip) and length(line) - length(replace(line, ',', '')) > length(line) - length(replace(line, ' ', ''))) as n_csv,
          count(*) filter (contains(line, cusip) and contains(upper(line), '<HTML>')) as n_html,
          count(*) filter (starts_with({_strip('line')}, cusip) and length({_strip('line')}) < length(cusip) + 5) as n_garbage
        from eligible group by file_id)""",
    "squeezed": f"""
      select file_id, line_no, cusip, {SQUEEZE.format('before')} as b, {SQUEEZE.format('after')} as a from split_all""",
    "cut_tab": _modal("split_all", "before", r"\t\w"),
    "cut_name": _modal("squeezed", "b", r"\s{2}\w"),
    "cut_value": _modal("squeezed", "a", r"\d\s{2,}\d", 1),
    "cuts": """
      select v.*, cast(t.pos as int) as tab_cut, cast(n.pos as int) as name_cut, cast(s.pos as int) as value_cut from votes v
      left join cut_tab t on t.file_id = v.file_id left join cut_name n on n.file_id = v.file_id
      left join cut_value s on s.file_id = v.file_id""",
    "rows_tab": f"""
      select s.file_id, s.line_no, 'tab' as layout, regexp_matches(before||after, {ANY}) as poss_hit,
        {_strip("substr(before, 1, coalesce(tab_cut, 30))")} as name,
        {_strip("substr(before, coalesce(tab_cut, 30) + 1)")} as type, {_strip('cusip')} as cusip,
        case when regexp_matches(after, '(\\d+)\\t+(\\d+)') then regexp_extract(after, '(\\d+)\\t+(\\d+)', 1) else {_strip('after')} end as value,
        case when regexp_matches(after, '(\\d+)\\t+(\\d+)') then regexp_extract(after, '(\\d+)\\t+(\\d+)', 2) else '-999999' end as shares,
        {_strip(_opt('before||after', 'after'))} as opt,
        {_strip("regexp_replace(after, '[^\\sA-Za-z]', '', 'g')")} as extra
      from split_all s join cuts c on c.file_id = s.file_id and c.layout = 'tab'""",
    "rows_fixed": f"""
      select s.file_id, s.line_no, 'fixed' as layout, regexp_matches(b||a, {ANY}) as poss_hit,
        {_strip(r"case when regexp_matches(b, '\s{2,}\w') then regexp_extract(b, '^(.*?)\s{2,}\w', 1) else substr(b, 1, coalesce(name_cut, 30)) end")} as name,
        {_strip(r"case when regexp_matches(b, '\s{2,}\w') then regexp_extract(b, '\s{2,}(\w.*)$', 1) else substr(b, coalesce(name_cut, 30) + 1) end")} as type,
        {_strip('cusip')} as cusip,
        {_strip(r"case when regexp_matches(a, '(\d+)\s{2,}(\d+)') then regexp_extract(a, '(\d+)\s{2,}(\d+)', 1) when regexp_matches(a, '(\d+)\s(\d+)') then regexp_extract(a, '(\d+)\s(\d+)', 1) when value_cut > 0 then substr(a, 1, value_cut) else a end")} as value,
        {_strip(r"case when regexp_matches(a, '(\d+)\s{2,}(\d+)') then regexp_extract(a, '(\d+)\s{2,}(\d+)', 2) when regexp_matches(a, '(\d+)\s(\d+)') then regexp_extract(a, '(\d+)\s(\d+)', 2) when value_cut > 0 then substr(a, value_cut + 1) else '-999999' end")} as shares,
        {_strip(_opt('b||a', 'a'))} as opt,
        {_strip("regexp_replace(a, '[^\\sA-Za-z]', '', 'g')")} as extra
      from squeezed s join cuts c on c.file_id = s.file_id and c.layout = 'fixed'""",
    "rows_csv": f"""
      select file_id, line_no, 'csv' as layout, regexp_matches(f[1]||array_to_string(f[5:], ' '), {ANY}) as poss_hit,
        f[1] as name, 'N/A' as type, f[2] as cusip, f[3] as value, f[4] as shares, 'N/A' as opt,
        array_to_string(f[5:], ' ') as extra
      from (select e.file_id, e.line_no,
          list_transform(regexp_extract_all(e.line||',', {FIELD}, 1), lambda x: {UNQUOTED.format('x')}) as f
        from eligible e join votes v on v.file_id = e.file_id and v.layout = 'csv')
      where len(f) > 5""",
    "holdings": "select * from rows_tab union all select * from rows_csv union all select * from rows_fixed",
    "stock": f"""
      select file_id as filename, split_part(file_id, '_', 1) as cik, split_part(file_id, '_', 2) as date, line_no,
        poss_hit, name, type, cusip, value, shares, opt, extra,
        case when not poss_hit then null when length(name) > {LONGEST_NAME} then 'Likely bad observation'
          when value = '' or shares = '' then 'Missing shares or value'
          when cusip = value or cusip = shares then 'Possible invalid CUSIP, same as shares or value'
          when upper(opt) in ({', '.join(map(_q, FALSE_OPTIONS))}) or regexp_matches(opt, '[^0-9A-Za-z]') then 'Likely false positive'
          else 'Likely true positive' end as flagr
      from holdings where not (poss_hit and (type = '-999999' or shares = '-999999'))""",
    "regions": """
      select *, coalesce(last_value(m ignore nulls) over (partition by file_id order by line_no rows unbounded preceding), false) as in_header
      from (select *, case when starts_with(line, '<SEC-HEADER>') then true when starts_with(line, '</SEC-HEADER>') then false end as m from fx_lines)""",
    "events": f"""
      select *, {', '.join(f"{_total(total)} as t_{_column(total)}" for total in TOTAL_RULES)},
        {_strip("regexp_extract(line, '[^:]*$')")} as value,
        case when in_header and contains(line, ':') and split_part(ltrim(line, {WS}), ':', 1) in ({', '.join(map(_q, HEADER_KEYS))})
          then split_part(ltrim(line, {WS}), ':', 1) end as key
      from regions""",
    "read": f"""
      select e.* from events e left join (
        select file_id, min(line_no) as stop from events
        where (key = {_q(VALUE_TOTAL)} and value <> '') or t_{_column(VALUE_TOTAL)} <> '' group by file_id) s
      on s.file_id = e.file_id where s.stop is null or e.line_no <= s.stop""",
    "read_totals": f"""
      select *, {', '.join(f"max(case when key = {_q(t)} then line_no end) over (partition by file_id) as r_{_column(t)}" for t in TOTAL_RULES)}
      from read""",
    "headers_found": f"select file_id, {', '.join(map(_header_column, HEADER_KEYS))} from read_totals group by file_id",
    "headers": f"""
      select file_id as file, {_q(FILING_URL)}||accession_number||'.txt' as url, {', '.join(_column(k) for k in HEADER_KEYS)}
      from headers_found""",
    "idx": f"""
      select year, quarter, {_strip('f[1]')} as cik, {_strip('f[2]')} as company, {_strip('f[3]')} as form_type,
        {_strip('f[4]')} as date_filed, {_strip('f[5]')} as filename
      from (select year, quarter, line, string_split(line, '|') as f from fx_index_lines)
      where len(f) >= 5 and {_strip('line')} <> 'CIK|Company Name|Form Type|Date Filed|Filename'""",
    "files": """
      select split_part(file_id, '_', 1) as cik, cast(year as varchar) as year, 'QTR'||quarter as qtr,
        '/archive/rawdata_'||year||'_QTR'||quarter as path, size, file_id||'.txt' as filename
      from (select file_id, year, quarter, cast(sum(strlen(line) + 1) as bigint) as size from fx_lines group by all)""",
    "ents": """
      select distinct ltrim(id, '0') as cik from (select reportedcik as id from fx_entities
        union all select wrds_cik from fx_entities union all select cik_may16 from fx_entities)""",
}


def _number(text: str) -> str:
    bare = f"replace({_strip(text)}, ',', '')"
    return f"case when regexp_matches({bare}, '^\\d+$') then cast({bare} as bigint) end"


def _coverage(p: str, lines: str) -> str:
    return f"""
      select file_id, count(*) as n_lines, count(*) filter (e) as n_eligible, count(*) filter (not e) as n_remainder
      from (select l.file_id, x.file_id is not null as e from {lines} l
        left join {p}eligible x on x.file_id = l.file_id and x.line_no = l.line_no) group by file_id"""


COLS = "file_id, line_no, poss_hit, name, type, cusip, value, shares, opt, extra"
COUNTS = "n_lines, n_tab, n_csv, n_html, n_garbage"
INDEX_COLS = "year, quarter, cik, company, form_type, date_filed, filename"
NAMES = [_column(total) for total in TOTAL_RULES]

QUERIES = {
    "filing_lines": f"select doc_id, line_no, rtrim(line, {WS}) as line from doc_lines",
    "file_key": "select file_id, split_part(file_id,'_',1) as cik, split_part(file_id,'_',2) as filed_on, split_part(file_id,'_',3) as ext from fx_filings",
    "skip_lines": "select file_id, line_no, raw as line from texts_in where skipped",
    "security_dictionary": "select key from dict",
    "lookup_keys": "select key from dict d where length(key) <= 6 or not exists (select 1 from dict s where s.key = substr(d.key, 1, 6))",
    "entity_ids": "select cik from ents",
    "eligible_rows": "select file_id, line_no, cusip, shprn, line from eligible",
    "remainder_lines": "select * from remainder",
    "coverage_check": _coverage("", "fx_lines"),
    "noise_coverage": _coverage("doc_", "doc_texts"),
    "share_tag": "select file_id, line_no, cusip, shprn from eligible",
    "split_on_id": "select file_id, line_no, before, after from split_all",
    "modal_split": "select file_id, tab_cut, name_cut, value_cut from cuts",
    "layout_vote": f"select file_id, {COUNTS}, layout from votes",
    "layout_profile": """
      select f.file_id, coalesce(layout, 'fixed') as layout, coalesce(n_lines, 0) as n_lines, coalesce(n_split, 0) as n_split,
        coalesce(n_tab, 0) as n_tab, coalesce(n_csv, 0) as n_csv, coalesce(n_html, 0) as n_html, coalesce(n_garbage, 0) as n_garbage,
        tab_cut, name_cut, value_cut from fx_filings f left join cuts c on c.file_id = f.file_id""",
    "frequent_splits": "select file_id, side, cast(pos as int) as pos, n from ("
        + _often("squeezed", "b", r"\s{2}\w", 0, "before", "+ 1") + " union all "
        + _often("squeezed", "a", r"\d\s{2,}\d", 1, "after", "- 1") + ")",
    "layout_tab": f"select {COLS} from rows_tab",
    "layout_csv": f"select {COLS} from rows_csv",
    "layout_fixed": f"select {COLS} from rows_fixed",
    "holdings_all": "select * from holdings",
    "option_token": "select file_id, line_no, poss_hit, opt from holdings",
    "quality_flag": "select filename, line_no, flagr from stock",
    "sentinel_skip": """
      select layout, poss_hit, count(*) as n_rows, count(*) filter (poss_hit and (type = '-999999' or shares = '-999999')) as n_dropped
      from holdings group by layout, poss_hit""",
    "merged_stock": "select * from stock",
    "merged_option": "select * from stock where poss_hit",
    "merged_option_def": "select * from stock where upper(opt) in ('CALL', 'PUT')",
    "merged_typed": f"select filename, line_no, {_number('value')} as value_num, {_number('shares')} as shares_num, cast(date as date) as filed_on from stock",
    "merged_as_written": """
      select filename as "Filename", cik as "CIK", date as "Date", case when poss_hit then 'True' else 'False' end as "Poss_hit",
        name as "Name", type as "Type", cusip as "CUSIP", value as "Value", shares as "Shares", opt as "Opt", extra as "Extra", flagr as "FlagR"
      from stock""",
    "option_audit": f"""
      select file_id, line_no, stage, text, cast(substr(split_part(file_id, '_', 2), 1, 4) as int) as year from (
        select file_id, line_no, 'line' as stage, line as text from eligible where regexp_matches(line, {ANY})
        union all select file_id, line_no, 'holding', 'true|'||name||'|'||type||'|'||cusip||'|'||value||'|'||shares||'|'||opt||'|'||extra
        from holdings where poss_hit)""",
    "header_region": "select file_id, line_no, in_header from regions",
    "table_region": f"""
      select file_id, line_no, coalesce(last_value(m ignore nulls) over (partition by file_id order by line_no rows unbounded preceding), false) as in_table
      from (select file_id, line_no, case when skipped then false when regexp_matches(line, {_rule('StopL')}) then false
        when regexp_matches(line, {_rule('UseL')}) then true end as m from texts_in)""",
    "header_fields": "select * from headers",
    "header_totals": f"select file, {', '.join(NAMES)}, {', '.join(f'{_number(n)} as {n}_num' for n in NAMES)} from headers",
    "holdings_with_header": """
      select h.file as filename, line_no, name, cusip, value, shares, opt, flagr, accession_number, company_conformed_name, conformed_period_of_report
      from headers h left join stock s on s.filename = h.file""",
    "totals_reconciled": f"""
      select file, n_reported, value_reported, n_found, value_found, n_reported = n_found as entries_agree, value_reported = value_found as values_agree
      from (select file, {_number(NAMES[1])} as n_reported, {_number(NAMES[2])} as value_reported,
          coalesce(n, 0) as n_found, v as value_found
        from headers left join (select filename, count(*) as n, cast(sum({_number('value')}) as bigint) as v from stock group by filename) on filename = file)""",
    "index_parse": f"select {INDEX_COLS} from idx",
    "index_period_prune": f"select year, quarter, count(*) as n_filings from idx where year in ({', '.join(map(str, PERIOD_YEARS))}) and quarter in ({', '.join(map(str, PERIOD_QUARTERS))}) group by year, quarter",
    "index_by_form": "select form_type, count(*) as n_filings, count(distinct cik) as n_filers, min(date_filed) as first_filed, max(date_filed) as last_filed from idx group by form_type",
    "index_by_filer": "select cik, count(*) as n_filings, min(date_filed) as first_filed, max(date_filed) as last_filed from idx group by cik",
    "filing_select": f"select {INDEX_COLS} from idx where form_type in ('13F-HR', '13F-HR/A', '13F-NT', '13F-NT/A')",
    "filing_select_ids": f"""select {INDEX_COLS} from idx where form_type in ('13F-HR', '13F-HR/A', '13F-NT', '13F-NT/A')
      and cik in (select reportedcik from fx_entities union all select wrds_cik from fx_entities union all select cik_may16 from fx_entities)""",
    "filing_select_all": f"select {INDEX_COLS} from idx",
    "filing_local_key": """
      select year, quarter, accession, ltrim(cik, '0')||'_'||filed_on||'_'||ltrim(cast(k + 1 as varchar), '0') as local_key,
        'rawdata_'||year||'_QTR'||quarter as folder from fx_filings""",
    "file_manifest": "select * from files",
    "manifest_subset": "select * from files where cik in (select cik from ents)",
    "curated_paths": "select cik, filename, path, '/curated'||substr(path, 9) as curated_path from files where cik in (select cik from ents)",
    "incremental_skip": "select file_id, cik, filed_on from fx_filings where file_id not in (select file_id from holdings)",
    "row_pattern_score": f"""
      select file_id, line_no, cast(hits as int) as hits, hits + 1 >= {len(SCORED)} as passes from (select file_id, line_no,
        {' + '.join('cast(' + ' or '.join(f"regexp_matches({c}, {_q('(?i)' + r)})" for c in SCORED) + ' as int)' for r in SCORE_RULES)} as hits from holdings)""",
    "stream_ingest": "select * from doc_remainder",
    "filing_identity": """
      select year, quarter, accession, local_key, 'rawdata_'||year||'_QTR'||quarter||'/'||local_key as file_id,
        count(*) over (partition by year, quarter, local_key) as n_same
      from (select year, quarter, accession, ltrim(cik, '0')||'_'||filed_on||'_'||ltrim(cast(k + 1 as varchar), '0') as local_key from fx_filings)""",
    "published_incremental": "select * from holdings",
    "published_rerun": f"""
      select 'eligible' as name, file_id, count(*) as n_rows from eligible group by file_id
      union all select 'remainder', file_id, count(*) from remainder group by file_id
      union all select 'layouts', file_id, 1 from fx_filings
      union all select 'holdings', file_id, count(*) from holdings group by file_id
      union all select 'option_audit', file_id, count(*) from (
        select file_id from eligible where regexp_matches(line, {ANY}) union all select file_id from holdings where poss_hit) group by file_id
      union all select 'stock', filename, count(*) from stock group by filename
      union all select 'option', filename, count(*) from stock where poss_hit group by filename
      union all select 'option_def', filename, count(*) from stock where upper(opt) in ('CALL', 'PUT') group by filename
      union all select 'headers', file_id, 1 from fx_filings""",
    "stream_published": "select * from holdings",
    "stream_headers": "select * from headers",
    "curated_archive": "select file_id, line_no, line from fx_lines where split_part(file_id, '_', 1) in (select cik from ents)",
    "index_files": f"select {INDEX_COLS} from idx",
    "reference_tables": "select key from dict",
}


def _needed(sql: str, seen: list[str]) -> list[str]:
    for name in TABLES:
        if name not in seen and re.search(rf"\b{name}\b", sql):
            _needed(TABLES[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def oracle_sql() -> dict[str, str]:
    out = {}
    for key, sql in QUERIES.items():
        tables = ",\n".join(f"{name} as ({TABLES[name]})" for name in _needed(sql, []))
        out[key] = f"with {tables}\n{sql}"
    return out
