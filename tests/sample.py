"""The night shift of a library's help desk: two rooms, two people who meet in one of them, two weeks."""

HEADER = ["Время", "Пользователь", "Chat UUID", "Чат", "role", "message"]

ROWS = [
    ("2026-05-18T22:10:00", "nadia", "room-a", "Night shift", "system", "You are the help desk of a library"),
    ("2026-05-18T22:11:00", "nadia", "room-a", "Night shift", "user", "The catalogue page shows a traceback since ten"),
    ("2026-05-18T22:12:00", "omar", "room-a", "Night shift", "user", "Same here, the grafana dashboard is red"),
    ("2026-05-18T22:13:00", "nadia", "room-a", "Night shift", "assistant", "The catalogue has been started again"),
    ("2026-05-18T22:20:00", "nadia", "room-a", "Night shift", "user", "It is back, please close the jira ticket"),
    ("2026-05-18T22:20:00", "nadia", "room-a", "Night shift", "user", "It is  back, please close\tthe jira ticket"),
    ("2026-05-18T23:59:00", "nadia", "room-a", "Night shift", "user", "Merci"),
    ("2026-05-19T08:00:00", "omar", "room-b", "Loans", "user", "Write an SQL query for all overdue loans"),
    ("2026-05-19T08:30:00", "omar", "room-b", "Loans", "user", "Now put the overdue loans into an excel sheet"),
    ("2026-05-25T09:00:00", "omar", "room-b", "Loans", "user", "The SQL needs the branch: select name from branch"),
    ("2026-05-25T09:05:00", "omar", "room-b", "Loans", "assistant", ""),
]
