"""Two routes over the standard library's HTTP server: health and a greeting."""

from __future__ import annotations

import json
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

ROUTES = {"/health": {"status": "ok"}, "/": {"message": "skyloom"}}


class Handler(BaseHTTPRequestHandler):
    def do_GET(self) -> None:  # noqa: N802  the server's name for it
        body = ROUTES.get(self.path)
        said = json.dumps(body if body is not None else {"error": "not found"}).encode()
        self.send_response(200 if body is not None else 404)
        self.send_header("Content-Type", "application/json")
        self.send_header("Content-Length", str(len(said)))
        self.end_headers()
        self.wfile.write(said)

    def log_message(self, *_args) -> None:
        pass


def server(host: str = "127.0.0.1", port: int = 8000) -> ThreadingHTTPServer:
    """A server that isn't running yet; ``serve_forever`` runs it."""
    return ThreadingHTTPServer((host, port), Handler)
