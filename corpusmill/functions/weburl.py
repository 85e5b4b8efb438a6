"""URLs as browsers read them, as column expressions: parsed against a base, in normal form.

A text goes through the URL standard's parser: scheme, credentials, host, port, path, query
and fragment, each percent-encoded by its own set. Backslashes are slashes where the scheme
is one of the web's, tabs and line feeds vanish, dot segments go, default ports too; hosts
are lower-cased, numbers in them become IPv4 addresses, IPv6 addresses are shortened, and
international names become ASCII ones. What can't be a URL is null, and so is null itself.

International names follow the tables of 2003 that Java has (which write ß as ss), and drive
letters of file URLs have no rules of their own; else the results are the standard's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the URL standard: schemes of the web with their ports, and what each part has encoded.
PORTS = {"ftp": "21", "http": "80", "https": "443", "ws": "80", "wss": "443"}
CONTROL = r"[^\x20-\x7e]"
FRAGMENT = r'[^\x21\x23-\x3b\x3d\x3f-\x5f\x61-\x7e]'
QUERY = r'[^\x21\x24-\x3b\x3d\x3f-\x7e]'
SPECIAL_QUERY = r"[^\x21\x24-\x26\x28-\x3b\x3d\x3f-\x7e]"
PATH = r'[^\x21\x24-\x3b\x3d\x40-\x5d\x5f\x61-\x7a\x7c\x7e]'
USERINFO = r"[^\x21\x24-\x2e\x30-\x39\x41-\x5a\x5f\x61-\x7a\x7e]"
FORBIDDEN_HOST = r"[\x00\t\n\r #/:<>?@\[\\\]^|]"
FORBIDDEN_DOMAIN = r"[\x00-\x20\x22#%/:<>?@\[\\\]^`{|}\x7f]"
OCTET = "(?:0|[1-9][0-9]?|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"

NONE = "struct<scheme:string,authority:string,path:string,query:string,fragment:string,opaque:boolean>"
#: What is in normal form as it is, but for the fragment and query that it doesn't have: most links of most pages.
SEGMENTS = r"(?:/(?!\.{1,2}(?:/|\z))[A-Za-z0-9!$&'()*+,;=:@_~.-]+)+/?"
ORIGIN = r"https?://[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]+"
PLAIN_PATH, PLAIN_BASE, PLAIN = rf"^{SEGMENTS}\z", rf"^({ORIGIN})(?:[/?#](?s:.*))?\z", rf"^{ORIGIN}(?:/|{SEGMENTS})\z"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is worked out once however often body has it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _has(text: Column, pattern: str) -> Column:
    return F.regexp_like(text, F.lit(pattern))


def _behind(text: Column, n: Column) -> Column:
    """text without its first n characters."""
    return F.substring(text, n + 1, F.length(text))


def percent_encoded(text: Column, unsafe: str) -> Column:
    """text with the characters of a class percent-encoded, in UTF-8."""
    byte = lambda c: F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    each = F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), lambda c: F.when(_has(c, unsafe), byte(c)).otherwise(c))
    return F.when(_has(text, unsafe), F.array_join(each, "")).otherwise(text)


def without_dots(path: Column) -> Column:
    """An absolute path without its . and .. segments; what leads above the top stays at the top."""
    dot = lambda x, n: F.lower(F.regexp_replace(x, "(?i)%2e", ".")) == "." * n
    parts = F.slice(F.split(path, "/"), 2, F.size(F.split(path, "/")))
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, x: F.when(dot(x, 2), F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(dot(x, 1), done).otherwise(F.concat(done, F.array(x))),
    )
    last = F.element_at(parts, -1)
    ends = F.when(dot(last, 1) | dot(last, 2), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(_has(path, r"(?i)/(?:\.|%2e){1,2}(?:/|\z)"), F.concat(F.lit("/"), F.array_join(ends, "/"))).otherwise(path)


def _number(part: Column) -> Column:
    """A part of an IPv4 address: decimal, octal behind 0, hexadecimal behind 0x; null if it is none or too large."""
    digits = F.regexp_replace(F.regexp_replace(part, "^0x", ""), "^0+(?=.)", "")
    of = lambda base: F.conv(digits, base, 10).cast("long")
    return (
        F.when(_has(part, r"^0x0*\z"), F.lit(0).cast("long"))
        .when(_has(part, r"^0x0*[0-9a-f]{1,8}\z"), of(16))
        .when(_has(part, r"^0+[0-7]{1,11}\z"), of(8))
        .when(_has(part, r"^(?:0|[1-9][0-9]{0,9})\z"), part.cast("long"))
    )


def ipv4(host: Column) -> Column:
    """The address as four numbers; null if it isn't one."""

    def shown(n: Column) -> Column:
        count = F.size(n)
        last = F.element_at(n, -1)
        front = F.slice(n, 1, count - 1)
        ok = (count <= 4) & ~F.exists(n, lambda x: x.isNull()) & F.forall(front, lambda x: x <= 255) & (last < F.pow(F.lit(256.0), F.lit(5) - count))
        whole = F.aggregate(F.transform(front, lambda x, i: x * F.pow(F.lit(256.0), F.lit(3) - i).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x) + last
        return F.when(ok, let(whole, lambda v: F.concat_ws(".", *(F.shiftright(v, k).bitwiseAND(255).cast("string") for k in (24, 16, 8, 0)))))

    return let(F.transform(F.split(F.regexp_replace(host, r"\.\z", ""), r"\."), _number), shown)


def ipv6(text: Column) -> Column:
    """The address in its shortest form; null if it isn't one."""
    tail = rf"^(.*:)({OCTET})\.({OCTET})\.({OCTET})\.({OCTET})\z"
    octet = lambda x, k: F.regexp_extract(x, tail, k).cast("int")
    pair = lambda x, k: F.lower(F.hex(octet(x, k) * 256 + octet(x, k + 1)))
    pieces = lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, ":"))

    def joined(all_: Column) -> Column:
        ok = (F.size(all_) == 8) & F.forall(all_, lambda p: _has(p, r"^[0-9a-f]{1,4}\z"))
        return F.when(ok, let(F.concat(F.lit(":"), F.array_join(F.transform(all_, lambda p: F.regexp_replace(p, "^0+(?=.)", "")), ":"), F.lit(":")), shortened))

    def shortened(s: Column) -> Column:
        """The first of the longest runs of zeros becomes two colons."""
        run = F.get(F.filter(F.array(*(F.lit(":" + "0:" * n) for n in range(8, 1, -1))), lambda r: F.contains(s, r)), F.lit(0))
        before = F.call_function("substring_index", s, run, F.lit(1))
        short = F.concat(F.ltrim(before, F.lit(":")), F.lit("::"), F.rtrim(_behind(s, F.length(before) + F.length(run)), F.lit(":")))
        return F.coalesce(short, F.trim(s, F.lit(":")))

    def spread(x: Column) -> Column:
        left, right = pieces(F.substring_index(x, "::", 1)), pieces(F.substring_index(x, "::", -1))
        zeros = F.lit(8) - F.size(left) - F.size(right)
        gap = F.when(_has(x, "::.*::|:::"), F.array().cast("array<string>")).when(zeros >= 1, F.concat(left, F.array_repeat(F.lit("0"), F.greatest(zeros, F.lit(0))), right)).otherwise(F.array().cast("array<string>"))
        return let(F.when(F.contains(x, F.lit("::")), gap).otherwise(F.split(x, ":")), joined)

    return let(let(F.lower(text), lambda x: F.when(_has(x, tail), F.concat(F.regexp_extract(x, tail, 1), pair(x, 2), F.lit(":"), pair(x, 4))).otherwise(x)), spread)


def host_of(host: Column, special: Column) -> Column:
    """A host in normal form; null if it can't be one."""

    def domain(name: Column) -> Column:
        return F.when((name == "") | _has(name, FORBIDDEN_DOMAIN), None).when(_has(name, r"(?:^|\.)(?:[0-9]+|0x[0-9a-f]*)\.?\z"), ipv4(name)).otherwise(name)

    def in_ascii(name: Column) -> Column:
        return F.lower(F.when(_has(name, r"^[\x00-\x7f]*\z"), name).otherwise(F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), name)))

    decoded = F.when(F.contains(host, F.lit("%")), F.try_url_decode(F.replace(host, F.lit("+"), F.lit("%2B")))).otherwise(host)
    address = F.concat(F.lit("["), ipv6(F.substring(host, F.lit(2), F.length(host) - 2)), F.lit("]"))
    return F.when(host.startswith("["), F.when(host.endswith("]"), address)).when(special, let(let(decoded, in_ascii), domain)).otherwise(F.when(~_has(host, FORBIDDEN_HOST), percent_encoded(host, CONTROL)))


def authority_of(text: Column, scheme: Column) -> Column:
    """Credentials, host and port as they are shown; null if there can't be such a host."""
    form = r"^(\[[^\]]*\]|[^:\[\]]*)(?::([0-9]*))?\z"
    special = scheme.isin(*PORTS, "file")

    def shown(a: Column) -> Column:
        user, word = F.substring_index(a["who"], ":", 1), F.regexp_extract(a["who"], "(?s)^[^:]*:(.*)", 1)
        who = F.concat(percent_encoded(user, USERINFO), F.when(word == "", "").otherwise(F.concat(F.lit(":"), percent_encoded(word, USERINFO))), F.lit("@"))
        default = F.element_at(F.create_map(*(F.lit(x) for pair in PORTS.items() for x in pair)), scheme)
        port = F.when((a["port"] == "") | F.coalesce(a["port"] == default, F.lit(False)), "").otherwise(F.concat(F.lit(":"), a["port"]))
        bad = ~a["ok"] | (a["host"] == "") & (scheme.isin(*PORTS) | F.contains(text, F.lit("@")) | F.contains(text, F.lit(":"))) | (F.length(a["port"]) > 5) | (F.lpad(a["port"], 5, "0") > "65535")
        host = F.when(a["host"] == "", "").otherwise(host_of(a["host"], special))
        whole = lambda h: F.when(scheme == "file", F.when(~_has(text, r"@|:[0-9]*\z"), F.regexp_replace(h, r"^localhost\z", ""))).otherwise(F.concat(F.when(_has(a["who"], r"^:?\z"), "").otherwise(who), h, port))
        return F.when(~bad, let(host, whole))

    at = F.regexp_extract(text, r"(?s)([^@]*)\z", 1)
    return let(
        F.struct(
            F.regexp_extract(text, "(?s)^(.*)@", 1).alias("who"),
            _has(at, form).alias("ok"),
            F.regexp_extract(at, form, 1).alias("host"),
            F.regexp_replace(F.regexp_extract(at, form, 2), "^0+(?=.)", "").alias("port"),
        ),
        shown,
    )


def parsed(text: Column, base: Column | None = None) -> Column:
    """scheme, authority, path, query, fragment and opaque (whether the path is one piece) of a text, read against a parsed base."""
    base = F.lit(None).cast(NONE) if base is None else base

    def split(t: Column) -> Column:
        before = F.substring_index(t, "#", 1)
        head = F.substring_index(before, "?", 1)
        scheme = F.regexp_extract(head, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
        return F.struct(
            F.lower(scheme).alias("scheme"),
            F.when(scheme == "", head).otherwise(_behind(head, F.length(scheme) + 1)).alias("body"),
            F.when(F.contains(before, F.lit("?")), _behind(before, F.length(head) + 1)).alias("query"),
            F.when(F.contains(t, F.lit("#")), _behind(t, F.length(before) + 1)).alias("fragment"),
        )

    def placed(u: Column) -> Column:
        """Of which scheme it is, and whether the rest is the base's."""
        scheme = F.when(u["scheme"] == "", base["scheme"]).otherwise(u["scheme"])
        special = scheme.isin(*PORTS, "file")
        body = F.when(special, F.translate(u["body"], "\\", "/")).otherwise(u["body"])
        return F.struct(scheme.alias("scheme"), F.coalesce(special, F.lit(False)).alias("special"), body.alias("body"), (u["scheme"] == "").alias("bare"), u["query"].alias("query"), u["fragment"].alias("fragment"))

    def led(p: Column) -> Column:
        """What is to be read as authority, if anything is, and what comes behind."""
        slashes = p["body"].startswith("//")
        relative = F.coalesce(base["scheme"].isNotNull() & ~base["opaque"] & (p["bare"] | p["special"] & (p["scheme"] == base["scheme"]) & ~slashes), F.lit(False))
        web = p["special"] & (p["scheme"] != "file")
        rest = F.when(web & (slashes | ~relative), F.regexp_replace(p["body"], "^/+", "")).when(slashes, _behind(p["body"], F.lit(2)))
        return F.struct(p.alias("p"), relative.alias("relative"), rest.alias("rest"), F.substring_index(rest, "/", 1).alias("name"))

    def cut(q: Column) -> Column:
        p, relative, led = q["p"], q["relative"], q["rest"].isNotNull()
        opaque = ~p["special"] & ~p["bare"] & ~p["body"].startswith("/")
        folder = F.concat(F.regexp_extract(base["path"], "(?s)^(.*)/", 1), F.lit("/"))
        path = F.when(led, _behind(q["rest"], F.length(q["name"]))).when(opaque | p["body"].startswith("/"), p["body"]).when(relative & (p["body"] == ""), base["path"]).when(relative, F.concat(folder, p["body"])).otherwise(F.concat(F.lit("/"), p["body"]))
        return F.struct(
            p["scheme"].alias("scheme"),
            p["special"].alias("special"),
            led.alias("led"),
            F.when(led, authority_of(q["name"], p["scheme"])).when(relative, base["authority"]).when(p["scheme"] == "file", "").alias("authority"),
            path.alias("path"),
            opaque.alias("opaque"),
            F.coalesce(p["query"], F.when(relative & ~led & (p["body"] == ""), base["query"])).alias("query"),
            p["fragment"].alias("fragment"),
        )

    def shown(c: Column) -> Column:
        path = F.when(c["opaque"], percent_encoded(c["path"], CONTROL)).when(c["special"] & (c["path"] == ""), "/").otherwise(let(without_dots(c["path"]), lambda p: percent_encoded(p, PATH)))
        query = F.when(c["special"], percent_encoded(c["query"], SPECIAL_QUERY)).otherwise(percent_encoded(c["query"], QUERY))
        whole = F.struct(c["scheme"].alias("scheme"), c["authority"].alias("authority"), path.alias("path"), query.alias("query"), percent_encoded(c["fragment"], FRAGMENT).alias("fragment"), c["opaque"].alias("opaque"))
        return F.when(c["scheme"].isNotNull() & ~(c["led"] & c["authority"].isNull()), whole)

    def read(t: Column) -> Column:
        whole = let(let(let(let(split(t), placed), led), cut), shown)
        same = F.struct(base["scheme"].alias("scheme"), base["authority"].alias("authority"), base["path"].alias("path"), base["query"].alias("query"), percent_encoded(_behind(t, F.lit(1)), FRAGMENT).alias("fragment"), base["opaque"].alias("opaque"))
        of_opaque = F.coalesce(base["opaque"], F.lit(False)) & ~_has(t, "^[A-Za-z][A-Za-z0-9+.-]*:")
        return F.when(of_opaque, F.when(t.startswith("#"), same)).otherwise(whole)

    clean = F.regexp_replace(F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+\z", ""), r"[\t\n\r]", "")
    return F.when(text.isNotNull(), let(clean, read))


def href_of(url: Column) -> Column:
    """A parsed URL as text."""
    front = F.when(url["authority"].isNotNull(), F.concat(F.lit("//"), url["authority"])).when(~url["opaque"] & url["path"].startswith("//"), "/.").otherwise("")
    more = lambda mark, part: F.when(url[part].isNull(), "").otherwise(F.concat(F.lit(mark), url[part]))
    return F.when(url["scheme"].isNotNull(), F.concat(url["scheme"], F.lit(":"), front, url["path"], more("?", "query"), more("#", "fragment")))


def url_href(text: Column, base: Column | None = None) -> Column:
    """text, read against base, as an absolute URL in normal form; null if that can't be.

    Plain paths and plain absolute URLs are taken as they are.
    """
    if base is None:
        return F.when(_has(text, PLAIN), text).otherwise(let(parsed(text), href_of))
    return F.element_at(hrefs_of(F.array(text), base), 1)


def hrefs_of(texts: Column, base: Column) -> Column:
    """url_href of every text of an array against one base, which is parsed once, and only where a text needs it.

    The base is read like the texts, in a round before them, so that the parser stands here once.
    """
    plain = F.regexp_extract(base, PLAIN_BASE, 1)
    easy = lambda t: _has(t, PLAIN) | _has(t, PLAIN_PATH) & (plain != "")
    short = lambda t: F.when(t.startswith("/"), F.concat(plain, t)).otherwise(t)
    kind = f"array<struct<url:{NONE},href:string>>"

    def round_(before: Column, now: Column) -> Column:
        first = F.size(before) == 0
        as_read = lambda t: let(parsed(t, F.get(before, F.lit(0))["url"]), lambda u: F.struct(u.alias("url"), href_of(u).alias("href")))
        as_is = lambda t: F.struct(F.lit(None).cast(NONE).alias("url"), short(t).alias("href"))
        return F.transform(now, lambda t: F.when(~first & easy(t), as_is(t)).otherwise(as_read(t)))

    full = F.transform(F.aggregate(F.array(F.array(base), texts), F.array().cast(kind), round_), lambda x: x["href"])
    nothing = F.transform(texts, lambda t: F.lit(None).cast("string"))
    return F.when(base.isNull(), nothing).when(F.forall(texts, lambda t: F.coalesce(easy(t), F.lit(True))), F.transform(texts, short)).otherwise(full)
