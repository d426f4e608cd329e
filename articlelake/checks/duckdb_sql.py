"""The same answers in plain SQL, computed from the source columns without XML, HTML or Spark."""

from articlelake.checks.corpus import SITE

DATE = "(date '2007-01-01' + (doc_id % 6000)::integer)"
DATE_TEXT = f"strftime({DATE}, '%-d %B %Y')"
FILE = "'corpus/' || printf('%06d', doc_id) || '.xml'"


def decoded(text: str) -> str:
    """The character references that occur in the pages."""
    for name, character in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"')):
        text = f"replace({text}, '{name}', '{character}')"
    return f"regexp_replace({text}, '&amp;?', '&', 'g')"


def untagged(html: str) -> str:
    return decoded(f"regexp_replace({html}, '<[^>]*>', '', 'g')")


VOLUME = "case when doc_id % 10 <> 3 then printf('%03d', doc_id % 17) end"
ISSUE = "case when doc_id % 10 <> 7 then (doc_id % 4)::varchar end"
STATUS = "case when doc_id % 11 = 0 then 'declaration_only' when doc_id % 7 = 0 then 'malformed' else 'ok' end"

# the file names of corpus.ODD_NAMES, and those of them that are read
ODD_NAME = """case doc_id % 10 when 2 then 'a[' || doc_id || '].xml' when 3 then 'a{' || doc_id || ',1}.xml'
    when 4 then 'a*' || doc_id || '.xml' when 5 then 'a?' || doc_id || '.xml' when 6 then 'a ' || doc_id || '#.xml'
    when 7 then 'a%20' || doc_id || '.xml' else printf('%06d', doc_id) || '.xml' end"""
READ_BACK = f"""printf('%06d', doc_id) as article_id, text as body_text, {ODD_NAME} as file_name from documents
    where doc_id % 10 < 8 and not (doc_id % 10 < 2 and (doc_id = 0 or printf('%06d', doc_id) like '999%'))"""

NAV = """select page_id, unnest(regexp_extract_all(nav, '<a href="([^"]*)">[^<]*</a>', 1)) as href,
    unnest(regexp_extract_all(nav, '<a href="[^"]*">([^<]*)</a>', 1)) as link_text,
    (generate_subscripts(regexp_extract_all(nav, '<a href="[^"]*">[^<]*</a>'), 1) - 1)::integer as pos
    from (select page_id, regexp_extract(html, '<nav>(.*?)</nav>', 1, 's') as nav from pages)"""

LABEL_LINKS = f"""select doc_id, quality, toxic, printf('%06d', doc_id // 2) as article_id,
    ((doc_id // 2) % 17)::varchar as volume, ((doc_id // 2) % 4)::varchar as issue from labels"""
LINKS = f"""select case when quality = 1 then 'Issue ' || volume || '.' || issue || ' of ' || doc_id end as issue_title,
    'Editor ' || toxic as scraped_editors, 'Author ' || doc_id as scraped_authors,
    case when toxic = 0 then '{SITE}/dhq/vol/' || volume || '/' || issue || '/' || article_id || '/' || article_id
        || '.html' end as article_link, 'Title ' || doc_id as article_title, '' as abstract_link,
    volume || '.' || issue as issue_text, '{SITE}/vol/' || volume || '/' || issue || '/index.html' as issue_link,
    volume, issue, article_id from ({LABEL_LINKS})"""
CRAWL = f"""select '{SITE}/dhq/vol/' || printf('%03d', (doc_id // 2) % 17) || '/' || (doc_id // 2) % 4 || '/'
    || printf('%06d', doc_id // 2) || '/' || printf('%06d', doc_id // 2) || '.html' as url,
    case when quality = 1 then 200 else 404 end as status, quality = 1 and toxic <> 1 as link_exists from labels"""
KEYS = """select doc_id as file_name, printf('%06d', doc_id // 2) as article_id,
    case when source <> 'src3' then (doc_id // 2) % 17 end::varchar as volume,
    ((doc_id // 2) % 4)::varchar as issue, lang, source from documents"""
DOCUMENT_LINKS = f"""select file_name, article_id, printf('%03d', volume::integer) as volume, issue,
    case when lang = 'de' then '{SITE}/own/' || file_name end as article_link from ({KEYS})"""
BUILT = f"'{SITE}/dhq/vol/' || volume || '/' || issue || '/' || article_id || '/' || article_id || '.html'"

MISSING = """select case when lang <> 'fr' then doc_id end::varchar as article_id, source, doc_id as article_link
    from documents where lang = 'fr' or doc_id not in (select doc_id from labels)"""

FIRST_VALUE = """first_value({c} ignore nulls) over (partition by volume, issue order by {order}, {c}
    rows between unbounded preceding and unbounded following)"""
PAGE_ISSUES = """select page_id, url, split_part(url, '/', 4) as volume,
    nullif(regexp_extract(split_part(url, '/', 3), '[^.]*$'), 'org') as issue,
    case when page_id % 3 = 1 then 't' || page_id % 50 end as issue_title,
    case when url like '%www%' then url end as issue_link from pages"""

CURATED = f"""
with files as (
    select {FILE} as file_name, doc_id, printf('%06d', doc_id // 2) as article_id,
        case when source <> 'src3' then printf('%03d', (doc_id // 2) % 17) end as volume,
        case when source <> 'src4' then ((doc_id // 2) % 4)::varchar end as issue,
        case when doc_id % 11 <> 5 then {DATE_TEXT} end as date_when,
        case when doc_id % 11 <> 5 then {DATE} end as date_processed,
        source as article_type, lang as language_ident, 'On ' || source as title, text as body_text
    from documents),
newest as (
    select * from files
    qualify row_number() over (partition by article_id order by date_when desc nulls last, file_name) = 1),
corrected as (
    select newest.* replace (
        case when toxic = 1 then '016' else coalesce(volume, 'yet to be assigned') end as volume,
        case when toxic = 1 then '4' else coalesce(issue, 'yet to be assigned') end as issue)
    from newest left join labels using (doc_id)),
dated as (
    select * replace (coalesce(date_processed, max(date_processed) over (partition by volume, issue)) as date_processed)
    from corrected),
links as (select * replace (printf('%03d', volume::integer) as volume) from ({LINKS})),
joined as (select * from dated left join links using (article_id, volume, issue)),
linked as (
    select * replace (case when article_link is null and {BUILT} in (select url from ({CRAWL}) where link_exists)
        then {BUILT} else article_link end as article_link) from joined),
curated as (
    select * replace ({", ".join(
        FIRST_VALUE.format(c=c, order="article_id, file_name") + " as " + c
        for c in ("issue_title", "scraped_editors", "issue_text", "issue_link"))}) from linked)
"""

LINES = """select doc_id, lang, source, unnest(string_split(text, chr(10))) as line,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no from documents where source <> 'src7'"""
CATALOG = f"""select 'Issue ' || doc_id as issue_title,
    case when lang = 'fr' then '' else 'Editor ' || source end as editors, 'Author ' || line_no as authors,
    '{SITE}/vol/' || doc_id || '/1/' || (doc_id * 1000 + line_no) || '/'
        || (doc_id * 1000 + line_no + case when lang = 'es' then 1 else 0 end) || '.html' as article_link,
    'Article ' || line_no as article_title, line as abstract, lang || ': ' || doc_id || '.1' as issue_text,
    '{SITE}/vol/' || doc_id || '/1/index.html' as issue_link,
    case when lang <> 'es' then printf('%03d', doc_id) end as volume,
    case when lang <> 'es' then '1' end as issue,
    case when lang <> 'es' then printf('%06d', doc_id * 1000 + line_no) end as article_id,
    doc_id, line_no, line, lang, doc_id * 1000 + line_no as id from ({LINES})"""
CATALOG_MISSING = f"""select * from ({CATALOG}) where lang = 'es' or line_no <> 0
    or doc_id not in (select doc_id from labels)"""
DELIVERED = f"select * from ({CATALOG_MISSING}) where lang <> 'es' and line_no <> 1"

ORACLES = {
    "scan_files": f"select {READ_BACK}",
    "scan_new_files": f"select case when lang = 'en' then 'first' else 'second' end as run, {READ_BACK}",
    "ingest_files": f"select {READ_BACK}",
    "ingest_updates": f"""select article_id, case when doc_id % 3 <> 0 and doc_id % 5 = 0 then body_text || ' changed'
            else body_text end as body_text, file_name
        from (select doc_id, {READ_BACK}) where doc_id % 7 <> 0""",
    "build_articles_append": f"""select article_id, 'yet to be assigned' as volume, 'yet to be assigned' as issue, body_text
        from (select {READ_BACK})""",
    "tei_body_text": "select doc_id, text as body_text from documents",
    "tei_metadata": f"""select {FILE} as file_name, printf('%06d', doc_id) as article_id, {VOLUME} as volume,
        {ISSUE} as issue, case when lang <> 'de' then source end as article_type,
        case when doc_id % 11 <> 5 then {DATE_TEXT} end as date_when,
        case when lang <> 'fr' then lang || ', ' || source end as keywords,
        case when lang <> 'es' then lang end as language_ident,
        case when lang not in ('de', 'fr') then 'About ' || source || ' ' end as abstract from documents""",
    "tei_title_mixed": f"""select {FILE} as file_name,
        'On ' || source || ' in ' || lang || ' of ' || n_chars || ' letters' as title from documents""",
    "tei_authors": f"""select {FILE} as file_name, i as position, case when i is not null then 'First' || i
            || case when (doc_id + i) % 3 <> 0 then ' Last' || doc_id else '' end end as author_name,
        case when i <> 1 then source end as affiliation,
        case when i = 0 then 'a' || doc_id || '@x.example' end as email,
        case when i = 2 then 'Writes ' || lang || ' texts' end as bio
        from documents left join (select unnest([0, 1, 2])::integer as i) on i < doc_id % 4""",
    "tei_quarantine": f"select {FILE} as file_name, {STATUS} as status from documents"
        .replace("else 'ok' end", "end"),
    "tei_status_counts": f"select {STATUS} as status, count(*) as articles from documents group by 1",
    "file_name_filter": """select doc_id, 'corpus/' || case doc_id % 15
        when 0 then printf('%06d.xml', doc_id) when 1 then printf('old/%06d.xml', doc_id)
        when 2 then 'old' || doc_id || '.xml' when 3 then printf('%06d_v1.xml', doc_id)
        when 4 then 'sample' || doc_id || '.xml' when 5 then doc_id || 'recovered.xml'
        when 6 then 'dhq' || doc_id || '.xml' when 7 then 'converted' || doc_id || '.xml'
        when 8 then doc_id || 'test.xml' when 9 then 'walsh' || doc_id || '.xml' when 10 then '999' || doc_id || '.xml'
        when 11 then '000000' || doc_id || '.xml' when 12 then doc_id || '.txt' when 13 then doc_id || '.XML'
        else 'Old' || doc_id || '.xml' end as path,
        case when doc_id % 15 in (0, 1) then regexp_matches(path, '/[0-9]+\\.xml$')
            and not regexp_matches(path, '/(999|000000)') else doc_id % 15 = 14 end as is_article from documents""",
    "nav_links": f"""select page_id, pos, '{SITE}' || {decoded('href')} as link, {decoded('link_text')} as link_text,
        href like '%vol%' or href like '%preview%' as is_issue from ({NAV})""",
    "page_hrefs": f"select page_id, pos, {decoded('href')} as href from ({NAV})",
    "page_toc": f"""select page_id, {decoded("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} as issue_title,
        '' as editors, null::varchar as authors, '{SITE}' || {decoded('href')} as article_link,
        {decoded('link_text')} as article_title, '' as abstract, null::varchar as volume, null::varchar as issue,
        null::varchar as article_id from ({NAV}) join pages using (page_id)""",
    "page_article": f"""select page_id, regexp_extract(html, '<html lang="([^"]*)">', 1) as header_lang,
        {decoded("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} as header_title,
        {decoded("regexp_extract(html, '<div class=.ad.>([^<]*)</div>', 1)")} as pubinfo,
        {untagged("regexp_extract(html, '<article>(.*?)</article>', 1, 's')")} as extracted_text,
        0::integer as n_notes from pages""",
    "xml_links": """select case lang when 'en' then '/dhq/vol/' || doc_id % 17 || '/' || doc_id % 4 || '/' || doc_id || '.xml'
            else 'http://x.example/dhq/vol/1/2/' || doc_id || '.xml?from=' || source end as xml_link,
        case lang when 'en' then (doc_id % 17)::varchar else '1' end as volume,
        case lang when 'en' then (doc_id % 4)::varchar else '2' end as issue,
        doc_id::varchar as article_id from documents where lang in ('en', 'de')""",
    "article_key": """select doc_id, case when good then printf('%03d', doc_id % 1500) end as volume,
        case when good then (doc_id % 4)::varchar end as issue, case when good then printf('%06d', doc_id) end as article_id
        from (select doc_id, lang <> 'es' and doc_id % 5 <> 0 as good from documents)""",
    "parse_dates": """select o_orderkey, case o_orderpriority
            when '2-HIGH' then strftime(o_orderdate, '%Y-%m-%d') when '3-MEDIUM' then strftime(o_orderdate, '%B %Y')
            when '4-NOT SPECIFIED' then 'Winter ' || year(o_orderdate)
            else strftime(o_orderdate, '%-d %B %Y') end as date_text,
        case o_orderpriority when '3-MEDIUM' then strftime(o_orderdate, '%Y-%m-01')
            when '4-NOT SPECIFIED' then null else strftime(o_orderdate, '%Y-%m-%d') end as day from orders""",
    "json_field": """select event_id, json_extract_string(props, '$.k') as k,
        json_extract_string(props, '$.k') as first_k from events""",
    "latest_by_text": """select o_custkey, o_orderkey, strftime(o_orderdate, '%-d %B %Y') as date_text from orders
        where o_custkey is not null
        qualify row_number() over (partition by o_custkey order by date_text desc nulls last, o_orderkey) = 1""",
    "latest_by_date": """select o_custkey, o_orderkey, strftime(o_orderdate, '%-d %B %Y') as date_text from orders
        where o_custkey is not null
        qualify row_number() over (partition by o_custkey order by o_orderdate desc nulls last, o_orderkey) = 1""",
    "fix_and_default": f"""select {FILE} as file_name,
        case when toxic = 1 then '016' else coalesce({VOLUME}, 'yet to be assigned') end as volume,
        case when toxic = 1 then '4' else coalesce({ISSUE}, 'yet to be assigned') end as issue
        from documents left join labels using (doc_id)""",
    "fill_dates": """select o_orderkey, o_orderstatus, o_orderpriority, strftime(coalesce(gapped,
            max(gapped) over (partition by o_orderstatus, o_orderpriority)), '%Y-%m-%d') as o_orderdate
        from (select *, case when o_orderkey % 10 <> 0 then o_orderdate end as gapped from orders)""",
    "fill_issue_attrs": f"""select page_id, url, volume, issue,
        case when issue is null then issue_title else {FIRST_VALUE.format(c='issue_title', order='url')} end as issue_title,
        case when issue is null then issue_link else {FIRST_VALUE.format(c='issue_link', order='url')} end as issue_link
        from ({PAGE_ISSUES})""",
    "fill_issue_gaps": f"""select page_id, url, volume, issue,
        case when issue is null then issue_title
            else coalesce(issue_title, {FIRST_VALUE.format(c='issue_title', order='url')}) end as issue_title,
        case when issue is null then issue_link
            else coalesce(issue_link, {FIRST_VALUE.format(c='issue_link', order='url')}) end as issue_link
        from ({PAGE_ISSUES})""",
    "link_join": f"select * from ({KEYS}) left join ({LINKS}) using (article_id, volume, issue)",
    "missing_articles": MISSING,
    "missing_count": f"select count(*) as missing from ({MISSING})",
    "fill_links": f"""select file_name, article_id, volume, issue, case when article_link is null
            and {BUILT} in (select url from ({CRAWL}) where link_exists) then {BUILT} else article_link end as article_link
        from ({DOCUMENT_LINKS})""",
    "link_exists": f"select url, status, link_exists from ({CRAWL})",
    "existing_links": f"""select file_name, {BUILT} as article_link from ({DOCUMENT_LINKS})
        where {BUILT} in (select url from ({CRAWL}) where link_exists)""",
    "union_backfill": """select o_orderkey, o_orderstatus,
        case when o_orderstatus = 'F' then strftime(o_orderdate, '%-d %B %Y') end as date_text from orders""",
    "resume_append": """select doc_id as file_name, text,
        case when doc_id in (select doc_id from labels) then 'first' else 'second' end as run from documents""",
    "snapshot_diff": """select 'd' || doc_id as path,
            case lang when 'fr' then 'removed' when 'de' then 'changed' else 'unchanged' end as change from documents
        union all select 'b' || item_id, 'added' from benchmark""",
    "latest_version": """select user_id::varchar as path, event_id, event_type || event_id as sha256 from events
        qualify row_number() over (partition by user_id order by ts desc, event_type || event_id desc) = 1""",
    "csv_round_trip": """select doc_id, text, lang, case when lang <> 'de' then source end as source, n_chars
        from documents""",
    "ingest_stream": f"""select {FILE} as file_name, printf('%06d', doc_id) as article_id, text as body_text,
        'ok' as status from documents""",
    "reuse_stage": "select * from documents",
    "stage_fingerprint": "select doc_id, lang from documents where lang = 'de'",
    "optional_backfill": f"""select {FILE} as file_name, source as article_type, null::varchar as date_processed,
        null::integer as n_authors from documents
        union all select 'backfill/' || printf('%06d', doc_id) || '.xml', 'backfill',
        case when quality = 1 then '2020-01-03' else '2020-01-02' end, null from labels""",
    "null_split": """select o_orderkey, case when o_orderkey % 10 <> 0 then strftime(o_orderdate, '%Y-%m-%d') end
            as o_orderdate, case when o_orderkey % 10 = 0 or o_orderdate is null then 'missing' else 'present' end as side
        from orders""",
    "counts_by_type": """select strftime(o_orderdate, '%Y-%m-%d') as date_processed, o_orderstatus as article_type,
        count(*) as articles from orders group by 1, 2""",
    "counts_by_lang": """select case when doc_id % 11 <> 5 then (2007 + doc_id % 17)::varchar end as date_processed,
        lang as language_ident, count(*) as articles from documents group by 1, 2""",
    "top_articles": "select doc_id, lang, n_chars from documents order by n_chars desc nulls last, doc_id limit 20",
    "curated_dataset": f"""{CURATED} select file_name, article_id, volume, issue, date_when,
        strftime(date_processed, '%Y-%m-%d') as date_processed, article_link, issue_title, scraped_editors,
        scraped_authors, issue_text, issue_link, article_title, language_ident, title, body_text from curated""",
    "report_by_type": f"""{CURATED} select strftime(date_processed, '%Y-%m-%d') as date_processed, article_type,
        count(*) as articles from curated group by 1, 2""",
    "report_by_language": f"""{CURATED} select strftime(date_processed, '%Y-%m-%d') as date_processed, language_ident,
        count(*) as articles from curated group by 1, 2""",
    "catalog_issues": f"""select '{SITE}/vol/' || doc_id || '/1/index.html' as issue_link,
            lang || ': ' || doc_id || '.1' as issue_text from documents
        union all select '{SITE}/preview/' || doc_id || '.html', 'Preview' from documents""",
    "catalog_articles": f"""select issue_title, editors, authors, article_link, article_title, abstract, issue_text,
        issue_link, volume, issue, article_id from ({CATALOG})""",
    "catalog_missing": f"select article_link, article_id from ({CATALOG_MISSING})",
    "catalog_xml_links": f"""select '/dhq/vol/' || doc_id || '/1/' || id || '.xml' as xml_link,
        doc_id::varchar as volume, '1' as issue, id::varchar as article_id from ({DELIVERED})""",
    "catalog_backfill": f"""select '{SITE}/dhq/vol/' || doc_id || '/1/' || id || '.xml' as file_name,
        id::varchar as article_id, doc_id::varchar as volume,
        regexp_replace(line, '^\\s+|\\s+$', '', 'g') as body_text from ({DELIVERED})
        where not starts_with(id::varchar, '999')""",
    "article_page_table": f"""select '{SITE}/page/' || doc_id as article_link, 'Title ' || doc_id as article_title,
        lang as issue_text, doc_id, source || ' · ' || doc_id as pubinfo,
        case when lang = 'es' then '' else lang end as header_lang, 'Title ' || doc_id as header_title,
        'A' || doc_id || '|B' as page_authors, case when lang = 'fr' then '' else 'In ' || lang end as article_abstract,
        replace(text, chr(10), '') as extracted_text, case when doc_id % 3 = 0 then '' else 'n' || doc_id || '|m' end as notes,
        case when doc_id % 4 = 0 then '' else 'Cited' end as works_cited,
        len(string_split(text, chr(10)))::integer as parts from documents where source <> 'src7'""",
    "page_notes": """select doc_id, p as position, case p when 0 then 'n' || doc_id else 'm' end as text
        from documents, (select unnest([0, 1])::integer as p) where source <> 'src7' and doc_id % 3 <> 0""",
}
