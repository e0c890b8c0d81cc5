"""Values that decide results and therefore may not vary.

Everything here is a fixed value: log line patterns, lookup tables, time
formats and alert limits. The logic that uses them lives elsewhere.
"""

# --- fixed values -----------------------------------------------------------

# Log line patterns, matched from the start of the line. Capture groups 1-6 are
# address, time text, method, url, status, size. The parsers run these and the
# stream patterns for time and url in an equivalent form that cannot backtrack
# over long lines (operators/parsing.py); the tests and the SQL checks hold that
# form against these.
CURRENT_PATTERN = r'(\d+\.\d+\.\d+\.\d+) - - \[(.*?)\] "(.*?) (.*?) HTTP/.*?" (\d+) (\d+)'
EXTENDED_PATTERN = r'(\d+\.\d+\.\d+\.\d+) - - \[(.*?)\] "(.*?) (.*?) HTTP.*?" (\d+) (\d+) ".*?" "(.*?)" (\d+)'
BASIC_PATTERN = r'(\d+\.\d+\.\d+\.\d+) - - \[(.*?)\] "(.*?) (.*?) HTTP.*" (\d+) (\d+)'

# Stream message patterns, searched anywhere in the message.
STREAM_TIME_PATTERN = r'\[(.*?)\]'
STREAM_METHOD_PATTERN = r'"(\w+) '
STREAM_URL_PATTERN = r'"(?:\w+) (.*?) HTTP'
STREAM_PROTOCOL_PATTERN = r'HTTP/\d.\d"'

# Positions in a stream message split at single blanks; the zone follows the time.
TOKEN_IP = 0
TOKEN_TIME = 3
TOKEN_METHOD = 5
TOKEN_URL = 6
TOKEN_STATUS = 8
TOKEN_SIZE = 9

# Patterns inside a url.
PRODUCT_QUERY_PATTERN = r'id=(\d+)'
PRODUCT_PATH_PATTERN = r'/products/(\d+)'
CATEGORY_PATH_PATTERN = r'/categories/(\w+)/'

# Product categories: the first category with a word that occurs in the url wins.
PRODUCT_CATEGORIES = {
    'maquillage': ['lipstick', 'foundation', 'mascara', 'eyeliner'],
    'soins_peau': ['skincare/cream', 'skincare/sunscreen'],
    'soins_capillaires': ['hair/shampoo', 'hair/conditioner'],
}
OTHER_CATEGORY = 'autre'
UNKNOWN_PATH_CATEGORY = 'unknown'

# Status labels.
STATUS_LABELS = {
    200: 'Succès',
    301: 'Redirection',
    403: 'Accès refusé',
    404: 'Non trouvé',
    500: 'Erreur serveur',
}
OTHER_STATUS = 'Autre'

# Alerts.
SPIKE_STATUSES = [404, 500]
SPIKE_WINDOW = '5 minutes'
TRENDING_MARKER = '/products/'
TRENDING_WINDOW = '1 minute'
TRENDING_MORE_THAN = 20
SUSPICIOUS_WINDOW = '1 minute'
SUSPICIOUS_MORE_THAN = 100

# Reports.
FIRST_ERROR_STATUS = 400
TOP_IPS = 10
TOP_PRODUCTS = 10
TOP_URLS = 5
LEAST_URLS = 3
ERROR_URLS = 10
PREVIEW_ROWS = 10
PRODUCT_RANGE_START = '2024-01-01 00:00:00'
PRODUCT_RANGE_END = '2025-02-10 00:00:00'

# --- end of fixed values ----------------------------------------------------
