"""A deterministic stand-in for the remote service, used by the fetch queries.

Key ``k`` (the integer value of the hex address) fails its first
``k % 12`` calls and then answers 200 with the document carried in the
request context.  The failing status cycles by call number.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values of the stub service.
FAIL_MODULUS = 12
FAILURE_CYCLE = ["429", "500", "400", "401", "timeout", "connection_error"]
# ---------------------------------------------------------------------------


class CyclingStubService:
    """fetch(req) -> (status, body); raises for timeout / connection errors.

    With ``as_of_ms`` given, calls for any other time fail."""

    def __init__(self, as_of_ms: int | None = None):
        self.as_of_ms = as_of_ms

    def __call__(self, req):
        if self.as_of_ms is not None and req.as_of_ms != self.as_of_ms:
            return 400, "stub: unexpected time"
        k = int(req.address[2:], 16)  # None / bad text -> exception -> 'error'
        if req.attempt <= k % FAIL_MODULUS:
            what = FAILURE_CYCLE[(req.attempt - 1) % len(FAILURE_CYCLE)]
            if what == "timeout":
                raise TimeoutError("stub: request timed out")
            if what == "connection_error":
                raise ConnectionError("stub: connection refused")
            return int(what), "stub error"
        return 200, req.context


def as_of_echo(req):
    """A service that always answers, with the time it was asked for as the balance."""
    token = '{"id":"t","name":"n","symbol":"S","balance":"%d","price":"1","usd":"1"}' % req.as_of_ms
    return 200, '{"ethereum":{"t":%s}}' % token
