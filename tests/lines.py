"""Hand-written lines and what each parser makes of them."""

LINES = {
    "plain": '192.168.1.1 - - [10/Feb/2025:07:05:13 +0000] "GET /products/12?id=7 HTTP/1.1" 404 512 "-" "Mozilla/5.0 (X)" 33',
    "no_zone": '192.168.1.1 - - [10/Feb/2025:07:05:13 ] "GET /home HTTP/1.1" 404 512 "Mozilla/5.0 (X)"',
    "offset": '192.168.1.1 - - [10/Feb/2025:07:05:13 +0100] "POST /skincare/cream?id=7 HTTP/1.0" 200 512 "-" "ua"',
    "no_size": '192.168.1.1 - - [10/Feb/2025:07:05:13 +0000] "GET / HTTP/1.1" 304 - "-" "ua"',
    "short": "x",
    "not_at_start": 'junk 1.1.1.1 - - [a] "GET / HTTP/1" 1 2',
    "bad_date": '192.168.1.1 - - [99/Foo/2025:07:05:13 +0000] "GET /skincare/cream/mascara?uid=5 HTTP/1.1" 200 10',
    "path_category": '10.0.0.9 - - [10/Feb/2025:07:05:13 -0530] "GET /categories/hats/products/3 HTTP/2" 200 7 "r" "a" 1',
    "blank_in_url": '10.0.0.9 - - [10/Feb/2025:07:05:13 +0000] "GET /a b HTTP/1.1" 200 7',
    "huge_numbers": '10.0.0.9 - - [10/Feb/2025:07:05:13 +0000] "GET / HTTP/1.1" 99999999999 99999999999999999999',
    "empty": "",
    "null": None,
}
