from keelson.sources.bind import BINDINGS, Fleet, oracle_with  # noqa: F401
