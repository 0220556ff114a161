import pytest
from test_daily import DAY, land_day, land_events
from test_staging import message, payload

from rankmill.__main__ import main


def test_jobs_from_the_command_line(spark, lake, capsys):
    land_day(spark, lake, DAY)
    land_day(spark, lake, "2026-01-01")
    land_events(spark, lake, [message(payload("a"))])
    root = ["--root", lake.root]
    assert main(["load", *root, "--date", DAY, "manufacturer"]) == 0
    assert "manufacturer$20260707: 2 rows" in capsys.readouterr().out
    main(["daily", *root, "--date", DAY, "--catalog"])
    assert "loaded 6 rows" in capsys.readouterr().out
    main(["recommend", *root, "dry", "--limit", "1"])
    assert capsys.readouterr().out.startswith("1\tp1\tn1\t1.0")
    main(["retention", *root, "--date", DAY])
    listed = capsys.readouterr().out.splitlines()
    assert len(listed) == 4 and all("dt=2026-01-01" in line for line in listed)
    main(["retention", *root, "--date", DAY, "--delete"])
    capsys.readouterr()
    main(["retention", *root, "--date", DAY])
    assert capsys.readouterr().out == ""
    with pytest.raises(ValueError):
        main(["recommend", *root, "robot"])
    with pytest.raises(SystemExit):
        main(["load", *root, "--date", DAY, "nowhere"])
