from hitsessions.operators.first_touch import first_touch_sessions, first_value_window
from hitsessions.operators.session_start import session_start_sessions

__all__ = ["first_touch_sessions", "first_value_window", "session_start_sessions"]
