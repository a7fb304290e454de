"""Re-export of the comparison normaliser used by scripts/compare_oracle.py."""
import importlib.util
import os

_p = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts", "compare_oracle.py")
_spec = importlib.util.spec_from_file_location("compare_oracle", _p)
_mod = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(_mod)
normalise = _mod.normalise
