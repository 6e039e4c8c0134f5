"""What the format readers must give back, said in SQL over the texts that the files were made from."""

from __future__ import annotations

_SPACES = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{3000}]+"


def normalised(x: str) -> str:
    """One newline form, single blanks, none at line ends, at most one empty line in a row, stripped."""
    s = f"regexp_replace(regexp_replace({x}, '\\r\\n|\\r', chr(10), 'g'), '[ \\t]{{2,}}', ' ', 'g')"
    s = f"regexp_replace(regexp_replace({s}, '(?m)[ \\t]+$', '', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"regexp_replace({s}, '^{_SPACES}|{_SPACES}$', '', 'g')"


#: Texts as the files hold them: without what XML cannot hold.
_DOCS = r"docs AS (SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0b-\x1f]', '', 'g') AS t, text AS raw FROM documents WHERE text IS NOT NULL)"
_LINES = "lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS ord FROM docs)"
_BLANK = f"regexp_replace(line, '{_SPACES}', '', 'g') = ''"


def _whole(suffix: str, text: str, unit_ref: str = "document", first: int = 0) -> str:
    """One unit a file, with the normalised text, where there is any."""
    return (
        f"SELECT doc_id || '{suffix}' AS path, 'document' AS unit_type, '{unit_ref}' AS unit_ref, {first} AS sequence, sha256(n) AS sha, length(n) AS chars, NULL::VARCHAR AS error_category "
        f"FROM (SELECT doc_id, {normalised(text)} AS n FROM docs) WHERE n <> ''"
    )


_HEADERS = "'From: a@office.example' || chr(10) || 'To: b@office.example' || chr(10) || 'Subject: Papers'"

UNITS = {
    "plain_units": f"WITH {_DOCS} {_whole('.txt', 'raw')}",
    "rtf_units": f"WITH {_DOCS} {_whole('.rtf', 't')}",
    "html_text": f"WITH {_DOCS} {_whole('.html', 'chr(10) || replace(t, chr(10), chr(10) || chr(10)) || chr(10) || chr(10) || chr(10) || ' + chr(39) + 'a' + chr(39))}",
    "email_units": f"""
WITH {_DOCS} {_whole('.eml', 't', 'body', 1)}
UNION ALL SELECT doc_id || '.eml', 'document', 'headers', 0, sha256({_HEADERS}), length({_HEADERS}), NULL FROM docs
""",
    "docx_units": f"""
WITH {_DOCS}, {_LINES},
kept AS (SELECT doc_id, ord, line, starts_with(line, '## ') AND NOT {_BLANK} AS head FROM lines WHERE NOT {_BLANK}),
placed AS (SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ord) AS unit_no FROM kept),
units AS (SELECT doc_id, unit_no, max(CASE WHEN head THEN regexp_replace(line, '^{_SPACES}|{_SPACES}$', '', 'g') END) AS head,
                 {normalised("string_agg(CASE WHEN head THEN regexp_replace(line, '^" + _SPACES + "|" + _SPACES + "$', '', 'g') ELSE line END, chr(10) ORDER BY ord)")} AS n
          FROM placed GROUP BY 1, 2)
SELECT doc_id || '.docx' AS path, CASE WHEN head IS NULL THEN 'document' ELSE 'heading' END AS unit_type, CASE WHEN head IS NULL THEN 'document' ELSE 'heading:' || head END AS unit_ref,
       CAST(row_number() OVER (PARTITION BY doc_id ORDER BY unit_no) - 1 AS INTEGER) AS sequence, sha256(n) AS sha, length(n) AS chars, NULL::VARCHAR AS error_category
FROM units WHERE n <> ''
""",
    "pptx_units": f"""
WITH {_DOCS},
parts AS (SELECT doc_id, unnest(string_split(t, chr(10) || chr(10))) AS line, generate_subscripts(string_split(t, chr(10) || chr(10)), 1) AS ord FROM docs),
slides AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS no, {normalised("line")} AS n FROM parts WHERE NOT {_BLANK})
SELECT doc_id || '.pptx' AS path, 'page' AS unit_type, 'slide:' || no AS unit_ref, CAST(no - 1 AS INTEGER) AS sequence, sha256(n) AS sha, length(n) AS chars, NULL::VARCHAR AS error_category
FROM slides
""",
    "pdf_pages": f"""
WITH {_DOCS}, p AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '[^\\x00-\\xff]', '?', 'g'), '\\n{{2,}}', chr(10), 'g'), '^{_SPACES}|{_SPACES}$', '', 'g') AS n FROM docs)
SELECT doc_id || '.pdf' AS path, 1 AS number, length(n) AS character_count, sha256(n) AS sha, 0.0 AS image_coverage, NULL::VARCHAR AS error_category FROM p
""",
    "flatten_records": """
SELECT r.table_id, r.row_no, j.key AS key, coalesce(j.value ->> '$', '') AS value
FROM (SELECT DISTINCT table_id, row_no, payload FROM raw_register WHERE payload IS NOT NULL) r, json_each(r.payload) j
""",
}
