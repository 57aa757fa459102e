"""The command line builds layers and prints reports over them."""

from support import SF0001


def test_build_and_report(spark, capsys):
    from racelake.__main__ import main
    from racelake.session import scratch_path

    out = scratch_path(spark, "t-cli")
    main(["build-from-tables", SF0001, out, "--min-athletes", "5"])
    assert "'silver/results': 2866" in capsys.readouterr().out
    main(["report", out, "gender_share"])
    text = capsys.readouterr().out
    assert "percentage" in text and "53.0" in text
