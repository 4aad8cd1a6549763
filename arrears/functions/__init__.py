from arrears.functions.derive import *  # noqa: F401,F403
