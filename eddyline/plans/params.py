"""Parameters of the registered queries on the test tables.

The reference's own 5 s / 2 s windows would give one-row windows on ``events``
(per-user gaps average hours), so the queries use day/hour scales; the
operator defaults and the fixtures keep the reference's values.
"""

TUMBLE = "1 day"
TUMBLE_OFFSET = "-8 hours"
SLIDE_SIZE = "1 day"
SLIDE_STEP = "6 hours"
SLIDE_OFF_SIZE = "12 hours"
SLIDE_OFF_STEP = "1 hour"
SLIDE_OFF_OFFSET = "-8 hours"
SESSION_GAP = "6 hours"
DYN_GAP_PURCHASE = "12 hours"
DYN_GAP_OTHER = "6 hours"
COUNT_SIZE = 5
COUNT_SLIDE = 2
GLOBAL_EVERY = 4
EVICT_KEEP = 3
EVICT_TIME = "6 hours"
EVICT_DELTA = 50.0
ALERT = 60.0
TRIGGER_SIZE = "30 days"
TRIGGER_EVERY = 5
LATE_SIZE = "1 hour"
LATE_BOUND = "4 hours"
LATE_LATENESS = "1 hour"
# arrival order that is not event-time order: event_id + (event_id * 37) % 101,
# ties broken by event_id
ARRIVAL_MULT = 37
ARRIVAL_MOD = 101
