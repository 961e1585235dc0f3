"""Shapes of the congressional tables: each column with the field that it is read from, and the tables' contracts."""

from __future__ import annotations

from recordloom.operators.tables import TableContract

_BILL = "nullif(concat_ws('-', identity.congress, identity.bill_type, identity.number), '')"
_VOTE = "concat_ws('-', vote.congress, vote.chamber, vote.session, vote.roll_number)"
_MEMBER = "coalesce(concat('lis:', nullif(member.lis_id, '')), nullif(member.bioguide_id, ''), concat('name:', member.name))"


def _same(prefix: str, *names: str) -> dict[str, str]:
    return {n: f"{prefix}.{n}" for n in names}


# The names of columns and of the fields behind them.
SHAPES: dict[str, dict[str, str]] = {
    "bills": {
        "bill_id": _BILL, "congress": "identity.congress", "bill_type": "identity.bill_type", "bill_number": "identity.number",
        **_same("status", "title", "origin_chamber"), "latest_action_date": "status.latest_action.action_date", "latest_action_text": "status.latest_action.text",
        "update_date": "status.update_date", "url": "status.legislation_url", **_same("status", "schema_version", "update_date_including_text", "introduced_date", "policy_area"),
        "subjects_json": "status.subjects", "subject_count": "size(status.subjects)", "sponsor_bioguide_id": "status.sponsors[0].bioguide_id", "sponsor_full_name": "status.sponsors[0].full_name",
        "cosponsor_count": "if(status.cosponsors is null, null, size(status.cosponsors))", "latest_action_time": "status.latest_action.action_time", "action_count": "size(status.actions)",
        "committee_count": "size(status.committees)", "version_count": "size(status.text_versions)", "stage": "stage.stage", "stage_rule": "stage.rule", "stage_matcher": "stage.matcher",
        "signed_date": "signing.signed_date", "signed_date_rule": "signing.rule", "public_law_number": "signing.public_law_number",
    },
    "bill_actions": {
        "bill_id": _BILL, "action_index": "action_index", **_same("action", "action_date", "action_time"), "action_text": "action.text",
        **_same("action", "action_code", "action_type", "source_system_code", "source_system_name"), "recorded_vote_count": "size(action.recorded_votes)",
        "is_latest_action": "is_latest", "stage": "stage.stage", "stage_rule": "stage.rule", "stage_matcher": "stage.matcher",
    },
    "bill_committees": {
        "bill_id": _BILL, **_same("committee", "system_code", "name", "chamber"), "committee_type": "committee.type", "parent_system_code": "parent_system_code",
        "is_subcommittee": "parent_system_code is not null", "snapshot_update_date": "update_date", "referral_signal": "referral_signal",
    },
    "bill_publisher_summaries": {
        "bill_id": _BILL, "summary_version_code": "summary.version_code", **_same("summary", "action_date", "action_desc", "update_date"),
        "summary_html": "summary.text", "summary_chars": "length(summary.text)",
    },
    "bill_cosponsors": {
        "bill_id": _BILL, "input_sha256": "input_sha256", "cosponsor_index": "cosponsor_index", **_same("entry", "bioguide_id", "full_name", "party", "state", "district", "sponsorship_date", "is_original_cosponsor"),
        "source_path": "concat('/billStatus/bill/cosponsors/item[', cosponsor_index + 1, ']')", "source_xml": "entry.source_xml",
    },
    "bill_sections": {
        "bill_id": _BILL, **_same("version", "version_code", "source"), "match_path": "concat_ws('|', node.match_path)", "match_path_json": "node.match_path", "display_path_json": "node.display_path",
        "element_id": "nullif(node.element_id, '')", "section_number": "node.section_number", "heading": "node.header_text", "body": "coalesce(node.body_text, '')",
        **_same("node", "display_text", "division_label", "division_key", "body_index"), "seq": "seq", "body_chars": "length(coalesce(node.body_text, ''))",
        "body_sha256": "concat('sha256:', sha2(coalesce(node.body_text, ''), 256))", "version_date": "version.date", "congress": "identity.congress",
    },
    "financial_changes": {
        "bill_id": _BILL, **_same("item", "from_version_code", "from_source", "to_version_code", "to_source", "seq"), "amount_index": "amount_index",
        **_same("pair", "label", "from_amount", "to_amount", "delta"),
    },
    "section_classifications": {
        "bill_id": _BILL, **_same("section", "version_code", "source", "match_path"),
        **_same("result", "label", "confidence", "model", "prompt_version", "prompt_hash", "batch_index", "requested_at", "completed_at"), "vocabulary_hash": "vocabulary_hash",
    },
    "amendments": {
        "amendment_id": "concat_ws('-', record.congress, lower(record.type), record.number)", "congress": "record.congress", "amendment_type": "lower(record.type)", "amendment_number": "record.number",
        **_same("record", "purpose", "description"), "proposed_date": "record.proposedDate", "submitted_date": "record.submittedDate", "chamber": "record.chamber", "update_date": "record.updateDate",
        "latest_action_date": "record.latestAction.actionDate", "latest_action_text": "record.latestAction.text", "sponsor_bioguide_id": "record.sponsors[0].bioguideId",
        "sponsor_full_name": "record.sponsors[0].fullName", "sponsor_party": "record.sponsors[0].party", "url": "record.url",
    },
    "press_releases": {
        "release_id": "concat('sha256:', sha2(concat_ws('|', release.chamber, release.link), 256))", "chamber": "release.chamber", "feed_url": "feed.url",
        **{f"channel_{n}": f"channel.{n}" for n in ("title", "link", "description", "language", "copyright", "docs", "last_build_date", "ttl")},
        "item_index": "release.index", **_same("release", "title", "link", "guid", "guid_is_permalink", "description", "description_text"),
        "description_chars": "length(release.description_text)", **_same("release", "pub_date", "author", "creator"), "categories_json": "release.categories",
        **_same("release", "enclosure_url", "enclosure_length", "enclosure_type"), "observed_at": "observed_at",
    },
    "roll_call_votes": {
        "vote_id": _VOTE, **_same("vote", "congress", "chamber", "session", "roll_number"), "vote_date": "vote.date", **_same("vote", "source_url", "question", "result"),
        **_same("tally", "yea", "nay", "present", "not_voting"), "tallies_json": "tallies", "member_vote_count": "member_vote_count",
    },
    "member_votes": {
        "vote_id": _VOTE, **_same("vote", "congress", "chamber", "session", "roll_number"), "member_key": _MEMBER, **_same("member", "bioguide_id", "lis_id"), "member_name": "member.name",
        **_same("member", "party", "state"), "position": "member.vote", "position_normalized": "member.vote_normalized", "vote_date": "vote.date",
    },
    "house_communications": {
        "communication_id": "concat_ws('-', read.congress, lower(read.communicationType.code), read.number)", "congress": "read.congress", "communication_type": "lower(read.communicationType.code)",
        "communication_type_name": "read.communicationType.name", "number": "read.number", "chamber": "read.chamber", "session": "read.sessionNumber", "abstract": "read.abstract",
        "report_nature": "read.reportNature", "legal_authority": "read.legalAuthority", "submitting_agency": "read.submittingAgency", "submitting_official": "read.submittingOfficial",
        "congressional_record_date": "read.congressionalRecordDate", "referral_system_code": "read.committees[0].systemCode", "referral_committee_name": "read.committees[0].name",
        "referral_date": "read.committees[0].referralDate", "committees_json": "read.committees", "update_date": "read.updateDate", "url": "read.url",
    },
    "treaties": {
        "treaty_id": "concat_ws('-', read.congressReceived, read.number, nullif(read.suffix, ''))", "congress_received": "read.congressReceived", "congress_considered": "read.congressConsidered",
        "number": "read.number", "suffix": "read.suffix", "old_number": "read.oldNumber", "old_number_display_name": "read.oldNumberDisplayName", "topic": "read.topic",
        "transmitted_date": "read.transmittedDate", "in_force_date": "read.inForceDate", "resolution_text": "read.resolutionText", "titles_json": "read.titles",
        "countries_json": "read.countriesParties.name", "index_terms_json": "read.indexTerms.name", "related_docs_json": "read.relatedDocs", "parts_json": "read.parts",
        "action_count": "read.actions.count", "actions_url": "read.actions.url",
        "package_id": "if(nullif(read.suffix, '') is null, concat('CDOC-', read.congressReceived, 'tdoc', read.number), null)", "update_date": "read.updateDate", "url": "read.url",
    },
    "nominations": {
        **_same("record", "citation", "congress", "number"), "part_number": "record.partNumber", **_same("record", "description", "organization"), "received_date": "record.receivedDate",
        "is_civilian": "record.nominationType.isCivilian", "nomination_type_json": "record.nominationType", "latest_action_date": "record.latestAction.actionDate",
        "latest_action_text": "record.latestAction.text", "update_date": "record.updateDate", "url": "record.url",
    },
    "laws": {
        "law_id": "concat_ws('-', record.congress, law.law_type, law.law_number)", "congress": "record.congress", "law_type": "law.law_type", "number": "law.law_number", "law_number": "law.number",
        "publisher_law_type": "law.type", "bill_id": "concat_ws('-', record.congress, lower(record.type), record.number)", "bill_type": "lower(record.type)", "bill_number": "record.number",
        "title": "record.title", "origin_chamber": "record.originChamber", "origin_chamber_code": "record.originChamberCode", "latest_action_date": "record.latestAction.actionDate",
        "latest_action_text": "record.latestAction.text", "update_date": "record.updateDate", "update_date_including_text": "record.updateDateIncludingText", "url": "record.url",
    },
}

_IDENTITY = {
    "bills": ("bill_id",), "bill_actions": ("bill_id", "action_index"), "bill_committees": ("bill_id", "system_code"), "bill_publisher_summaries": ("bill_id", "summary_version_code", "action_date"),
    "bill_cosponsors": ("bill_id", "input_sha256", "cosponsor_index"), "bill_sections": ("bill_id", "version_code", "source", "seq"),
    "financial_changes": ("bill_id", "from_version_code", "from_source", "to_version_code", "to_source", "seq", "amount_index"), "section_classifications": ("bill_id", "version_code", "source", "match_path"),
    "amendments": ("amendment_id",), "press_releases": ("release_id",), "roll_call_votes": ("vote_id",), "member_votes": ("vote_id", "member_key"), "house_communications": ("communication_id",),
    "treaties": ("treaty_id",), "nominations": ("citation",), "laws": ("law_id",),
}

CONTRACTS = {
    name: TableContract(name, tuple(shape), _IDENTITY[name], references={c: t for c, t in (("bill_id", ("bills", "bill_id")), ("vote_id", ("roll_call_votes", "vote_id"))) if c in shape and name not in ("bills", "roll_call_votes")})
    for name, shape in SHAPES.items()
}
